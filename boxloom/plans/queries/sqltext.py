"""Pieces of SQL shared by the oracles."""


def inter(a: str, b: str, u: int = 0) -> str:
    return (f"(greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1) + {u}) * "
            f"greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1) + {u}))")


def area(a: str, u: int = 0) -> str:
    return f"(({a}.x2 - {a}.x1 + {u}) * ({a}.y2 - {a}.y1 + {u}))"


def union(a: str, b: str, u: int = 0) -> str:
    return f"({area(a, u)} + {area(b, u)} - {inter(a, b, u)})"


def iou(a: str, b: str, u: int = 0) -> str:
    return f"({inter(a, b, u)} / {union(a, b, u)})"


BOX = "x1 := x1, y1 := y1, x2 := x2, y2 := y2"
BOXTYPE = "x1 double, y1 double, x2 double, y2 double"


def leaders(source: str, keys: str, order: str, fields: str, types: str, related: str) -> str:
    """A CTE body with, per group, all rows ``m`` in order and the greedy leaders ``lead``; ``related`` is over
    ``k`` (leader) and ``d`` (row)."""
    return f"""select {keys}, m, list_reduce(m, lambda acc, d: case when
      len(list_filter(acc, lambda k: {related})) > 0 then acc else list_append(acc, d) end,
      cast([] as struct({types})[])) as lead
    from (select {keys}, list(struct_pack({fields}) order by {order}) as m from {source} group by {keys})"""
