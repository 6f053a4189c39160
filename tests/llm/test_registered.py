"""The registered training-data queries."""

from scriptorium.llm import registered


def test_queries_and_statements():
    q, o = registered()
    assert sorted(int(n[2:].split("_")[0]) for n in q if n.startswith("op")) == list(range(1, 14)) and "pipeline" in q
    assert all(isinstance(v, str) for v in o.values())
    assert {n.split("_")[0] for n in o} == {"op8", "op12", "op13"}
