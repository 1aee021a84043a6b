"""Helpers that several tests share."""


def by_id(rows, *columns):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(tuple(r[c] for c in columns))
    return out
