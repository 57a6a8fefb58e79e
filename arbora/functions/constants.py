"""Fixed values of the outcome-tree semantics."""

#: Games per unit of prior, and standard deviations in a lower bound.
K0 = 30.0
Z = 2.0
SOLID = 150.0
#: Strength of the neighbour prior and weight of one band's distance, by rating band.
S_PRIOR = [179.5, 635.0, 755.5, 733.0, 642.5, 530.5, 392.5, 292.0, 37.0]
NEIGHBOUR_WEIGHT = [0.45, 0.45, 0.6, 0.75, 0.9, 0.75, 0.6, 0.225, 0.225]
BANDS = 9
TERM, AGG = "(TERM)", "(AGG)"
#: Node totals under which a node is dropped, or is a leaf.
DROP, LEAF = 50, 150
MERGE_FLOOR = 5
#: Calibration: least games of a target cell and of a drift cell, and the cap of the strength.
TARGET_MIN, N_DRIFT, S_CAP = 200, 500, 2000.0
GRID = [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9]
EXCELLENT_MARGIN, SIDELINE_SHARE = 0.02, 0.05
#: Verifying: tolerance of values, and the games and support under which a pick is thin; nodes with fewer games do not warn.
VALUE_TOLERANCE, MIN_MOVE_GAMES, MIN_SUPPORT, MIN_NODE_GAMES = 2e-3, 20, 50, 1000
#: Counter headers: their keys, most bytes, and the largest count and page load time.
COUNTERS = ["pl", "ch", "cm", "ee", "ea", "wn", "ws", "vr", "vs"]
HEADER_BYTES, MOST_COUNT, MOST_LOAD_MS = 256, 10_000, 600_000
#: Solving: most sweeps, the sweep from which picks are kept, and the residual under which values are settled.
MOST_SWEEPS, FREEZE_AFTER, SETTLED = 10_000, 1_000, 1e-6
