"""URL parts, reference resolution and address tests as Column expressions."""

from __future__ import annotations

import ipaddress
from functools import reduce
from operator import or_
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import bind

_LEADING = "".join(map(chr, range(0x21)))
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _tidy(url: Column) -> Column:
    """Leading control characters and blanks go, tabs and newlines go everywhere."""
    return F.translate(F.ltrim(url, F.lit(_LEADING)), "\t\r\n", "")


def scheme(url: Column) -> Column:
    """Lower-case scheme, empty when there is none."""
    return F.lower(F.regexp_extract(_tidy(url), _SCHEME, 1))


def netloc(url: Column) -> Column:
    """The authority: user info, host and port."""
    return F.regexp_extract(_tidy(url), _AUTHORITY, 1)


def hostname(url_netloc: Column) -> Column:
    """Lower-case host of an authority, without user info, port and brackets."""
    host_port = F.regexp_extract(url_netloc, r"([^@]*)$", 1)
    return F.lower(F.coalesce(
        F.nullif(F.regexp_extract(host_port, r"\[([^\]]*)", 1), F.lit("")),
        F.regexp_extract(host_port, r"^([^:\[]*)", 1)))


# --- resolving a reference against a base ---------------------------------------------
# Plain forms are resolved by expressions; the rest (an own scheme without "//", path
# parameters, brackets, blanks inside, empty query or fragment marks, non-ASCII
# authorities) goes to the standard library in Arrow batches.
_ODD_REFERENCE = (r"[;\[\]\x00-\x20]|\?(?:#|$)|#$|^(?i:https?:(?!//))|^(?i:https?:)?//[^/?#]*[^\x00-\x7f]"
                  r"|^//(?:[/?#]|$)|^(?i:https?:)//(?:[/?#]|$)|^[A-Z]+[a-zA-Z]*://|^[a-zA-Z]+[A-Z]+[a-zA-Z]*://")
_ODD_BASE = r"[;\[\]\x00-\x20]|^(?!https?://[^/?#]+)|^https?://[^/?#]*[^\x00-\x7f]"


def _remove_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments; ``path`` starts with ``/``."""
    segments = F.split(path, "/")
    stack = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    joined = F.array_join(
        F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(stack, F.array(F.lit(""))))
        .otherwise(stack), "/")
    rooted = bind(joined, lambda j: F.when(j.startswith("/"), j).otherwise(F.concat(F.lit("/"), j)))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), rooted).otherwise(path)


def _resolve_plain(base: Column, ref: Column) -> Column:
    site = F.regexp_extract(base, r"^(https?://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^https?://[^/?#]*([^?#]*)", 1)
    base_query = F.regexp_extract(base, r"^[^#?]*(\?[^#]+)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(base_path, r"^/?(.*/)?[^/]*$", 1))
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    tail = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    # repeated slashes inside a merged path collapse, those of a rooted one stay
    merged = F.regexp_replace(F.concat(folder, path), r"/{2,}", "/")
    return (
        F.when(ref.rlike(_SCHEME), ref)
        .when(ref.startswith("//"), F.concat(F.regexp_extract(base, r"^(https?:)", 1), ref))
        .when(ref.startswith("?"), F.concat(site, base_path, ref))
        .when(ref.startswith("#"), F.concat(site, base_path, base_query, ref))
        .when(ref.startswith("/"), F.concat(site, _remove_dots(path), tail))
        .otherwise(F.concat(site, _remove_dots(merged), tail)))


def resolve_all(base: Column, refs: Column) -> Column:
    """Absolute form of every reference of an array.

    Only pages that hold an unusual form are sent to Python; others travel as nulls. A
    reference the standard library rejects stays as it is.
    """
    odd = base.rlike(_ODD_BASE) | F.exists(refs, lambda r: r.rlike(_ODD_REFERENCE))
    by_library = _library_udf()(F.when(odd, base), F.when(odd, refs))
    return F.coalesce(by_library, F.transform(refs, lambda r: _resolve_plain(base, r)))


def _library_udf():
    def join(base: str, ref: str) -> str:
        try:
            return urljoin(base, ref)
        except ValueError:
            return ref

    def resolve(bases: pd.Series, refs: pd.Series) -> pd.Series:
        return pd.Series([
            None if base is None or page is None else [join(base, r) for r in page]
            for base, page in zip(bases, refs)], dtype=object)

    return F.pandas_udf(resolve, T.ArrayType(T.StringType()))


# --- addresses ------------------------------------------------------------------------
_IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?!$)|$)){4}$"
_IPV6 = (r"^(?=.*:)(?!:[^:])(?!.*[^:]:$)(?!.*:::)(?!.*::.*::)"
         r"[0-9a-f:]+(?:[0-9]+(?:\.[0-9]+){3})?$")


def is_ipv4(host: Column) -> Column:
    return host.rlike(_IPV4)


def ipv4_number(host: Column) -> Column:
    """Dotted quad as a number, null for anything else."""
    parts = F.split(host, r"\.")
    number = reduce(lambda acc, i: acc * 256 + F.get(parts, F.lit(i)).try_cast("bigint"),
                    range(1, 4), F.get(parts, F.lit(0)).try_cast("bigint"))
    return F.when(is_ipv4(host), number)


def ipv6_hex(host: Column) -> Column:
    """The 32 hex digits of an IPv6 address, null for anything else."""
    dotted = F.regexp_extract(host, r":((?:[0-9]+\.){3}[0-9]+)$", 1)
    head = F.regexp_extract(host, r"^(.*:)[^:]*$", 1)
    plain = F.when(~host.contains("."), host).otherwise(bind(
        ipv4_number(dotted),
        lambda n: F.concat(head, F.hex(F.shiftright(n, 16)), F.lit(":"), F.hex(n.bitwiseAND(F.lit(0xFFFF))))))

    def groups(side: Column) -> Column:
        return F.filter(F.split(F.coalesce(side, F.lit("")), ":"), lambda g: g != "")

    def expand(sides: Column) -> Column:
        left, right = groups(F.get(sides, F.lit(0))), groups(F.get(sides, F.lit(1)))
        zeros = F.when(F.size(sides) == 2, F.greatest(8 - F.size(left) - F.size(right), F.lit(1)))
        filled = F.concat(left, F.array_repeat(F.lit("0"), F.coalesce(zeros, F.lit(0))), right)
        return bind(filled, digits)

    def digits(filled: Column) -> Column:
        sound = (F.size(filled) == 8) & F.forall(filled, lambda g: F.length(g) <= 4)
        return F.when(sound, F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))

    return F.when(F.lower(host).rlike(_IPV6), bind(F.split(F.lower(plain), "::", -1), expand))


def in_networks(v4: Column, v6: Column, networks: list[str]) -> Column:
    """Whether an address lies in one of the CIDR ranges; null when it is no address.

    Takes the forms of :func:`ipv4_number` and :func:`ipv6_hex`, of which one is null at
    least; the families never match across. The list is a parameter of fixed size and
    becomes comparisons with constants.
    """
    ranges = {4: [], 6: []}
    for net in map(ipaddress.ip_network, networks):
        lo, hi = int(net.network_address), int(net.broadcast_address)
        ranges[net.version].append((lo, hi) if net.version == 4 else (f"{lo:032x}", f"{hi:032x}"))

    def inside(address: Column, version: int) -> Column:
        return reduce(or_, [address.between(*r) for r in ranges[version]], F.lit(False))

    return F.when(v4.isNotNull(), inside(v4, 4)).when(v6.isNotNull(), inside(v6, 6))


def is_mapped_ipv4(v6: Column) -> Column:
    """IPv4 written inside IPv6 (``::ffff:a.b.c.d``)."""
    return F.coalesce(v6.startswith("0" * 20 + "ffff"), F.lit(False))
