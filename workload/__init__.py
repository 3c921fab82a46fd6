"""The registered queries, the derived views they run on and their SQL counterparts."""
