import random

from tidegate.operators import conversations as C


def log(seed=11):
    rng = random.Random(seed)
    texts = ["hello", "terminate", "TERMINATE now", "SECURITY REVIEW PASSED ok", "CODE APPROVED", None]
    weights = [12, 2, 1, 2, 2, 1]
    return [(c, 2 * t + c % 2, "user", rng.choices(texts, weights)[0])
            for c in range(40) for t in range(rng.randint(1, 12))]


def expected(turns, cap):
    kept, outcome = set(), {}
    for c in {t[0] for t in turns}:
        mine = sorted(t for t in turns if t[0] == c)
        used, ended = [], False
        for t in mine[:cap]:
            used.append(t)
            if "TERMINATE" in (t[3] or ""):
                ended = True
                break
        kept |= {(c, t[1]) for t in used}

        def first(marker):
            return next((t[1] for t in mine if marker in (t[3] or "")), None)

        outcome[c] = (first("TERMINATE"), first("SECURITY REVIEW PASSED"), first("CODE APPROVED"),
                      len(mine), len(used), not ended and len(mine) > len(used))
    return kept, outcome


def test_truncation_and_outcome(spark):
    turns = [(c, t, r, x) for c, t, r, x in log()]
    turns.sort(key=lambda t: t[1:2])
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for cap in (20, 5):
        kept, outcome = expected([(c, t, r, x or "") for c, t, r, x in turns], cap)
        assert {(r.conv_id, r.turn) for r in C.truncate_conversations(df, max_rounds=cap).collect()} == kept
        got = {r.conv_id: tuple(r)[1:] for r in C.conversation_outcome(df, max_rounds=cap).collect()}
        assert got == outcome


def test_each_task_keeps_only_the_capped_rounds(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = C.truncate_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_marker_is_a_parameter(column):
    assert column(lambda c: C.is_termination(c, "DONE"), ["all DONE", "done", None]) == [True, False, False]
