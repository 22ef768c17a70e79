"""Views on the given tables, the registered queries, and SQL with the same results."""

from importlib import import_module

MODULES = ("cleaning", "alignment", "responses", "tables_and_sets", "round_trips", "edge_cases")
QUERIES, ORACLES = {}, {}
for _name in MODULES:
    _module = import_module(f"{__name__}.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES

# the older names of queries that now run over all cells and planes
for _old, _new in (("g5_upsample", "g5_upsample_cells"), ("a7_peri_event_z", "a7_peri_event_z_planes"), ("g3_align_trace", "g3_align_trace_planes")):
    QUERIES[_old], ORACLES[_old] = QUERIES[_new], ORACLES[_new]
