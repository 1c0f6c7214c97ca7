"""A small fixed isolation forest over (l_quantity, l_extendedprice).

Registered anomaly queries score with this forest so an SQL engine can score
the same points from its leaf boxes. (Fitting — a random process — is shown by
``forest_fit``, which is checked by row count.)
"""

from __future__ import annotations

import pandas as pd

from ..operators.anomaly import c_factor

PSI = 256
FEATURES = ["l_quantity", "l_extendedprice"]

# --- fixed values: (tree, node, feature, threshold, left, right, depth, leaf size) ---
NODES = [
    (0, 0, 0, 25.5, 1, 2, 0, None), (0, 1, 1, 30000.0, 3, 4, 1, None), (0, 2, 1, 90000.0, 5, 6, 1, None),
    (0, 3, -1, None, -1, -1, 2, 60), (0, 4, -1, None, -1, -1, 2, 8), (0, 5, -1, None, -1, -1, 2, 40),
    (0, 6, 0, 48.5, 7, 8, 2, None), (0, 7, -1, None, -1, -1, 3, 20), (0, 8, -1, None, -1, -1, 3, 1),
    (1, 0, 1, 50000.0, 1, 2, 0, None), (1, 1, 0, 10.5, 3, 4, 1, None), (1, 2, -1, None, -1, -1, 1, 30),
    (1, 3, -1, None, -1, -1, 2, 25), (1, 4, -1, None, -1, -1, 2, 100),
    (2, 0, 0, 40.5, 1, 2, 0, None), (2, 1, 1, 80000.0, 3, 4, 1, None), (2, 2, 1, 95000.0, 7, 8, 1, None),
    (2, 3, 0, 5.5, 5, 6, 2, None), (2, 4, -1, None, -1, -1, 2, 2), (2, 5, -1, None, -1, -1, 3, 15),
    (2, 6, -1, None, -1, -1, 3, 150), (2, 7, -1, None, -1, -1, 2, 12), (2, 8, -1, None, -1, -1, 2, 1),
]
# --- end of fixed values ---


def nodes_frame() -> pd.DataFrame:
    rows = [(t, n, f, thr, lft, rgt, (d + c_factor(size)) if f < 0 else None)
            for t, n, f, thr, lft, rgt, d, size in NODES]
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "leaf_len"])


def leaf_boxes() -> list[tuple[int, list[float], list[float], float]]:
    """(tree, lo, hi, path_len) per leaf; a point is in the box when lo <= x < hi."""
    df = nodes_frame()
    out = []
    for t, g in df.groupby("tree"):
        by_id = {int(r.node): r for r in g.itertuples()}
        stack = [(0, [float("-inf")] * len(FEATURES), [float("inf")] * len(FEATURES))]
        while stack:
            nid, lo, hi = stack.pop()
            r = by_id[nid]
            if r.feature < 0:
                out.append((int(t), lo, hi, float(r.leaf_len)))
                continue
            f = int(r.feature)
            lhi, rlo = list(hi), list(lo)
            lhi[f] = min(hi[f], r.threshold)
            rlo[f] = max(lo[f], r.threshold)
            stack.append((int(r.left), lo, lhi))
            stack.append((int(r.right), rlo, hi))
    return out


def leaves_values_sql() -> str:
    def num(v: float) -> str:
        if v == float("inf"):
            return "CAST('infinity' AS DOUBLE)"
        if v == float("-inf"):
            return "CAST('-infinity' AS DOUBLE)"
        return repr(float(v))
    rows = [f"({t}, {num(lo[0])}, {num(hi[0])}, {num(lo[1])}, {num(hi[1])}, {num(p)})" for t, lo, hi, p in leaf_boxes()]
    return "(VALUES " + ", ".join(rows) + ") AS l(tree, x_lo, x_hi, y_lo, y_hi, path_len)"
