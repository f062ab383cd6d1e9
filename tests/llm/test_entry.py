import __spark_entry__ as contract
from skyledger.llm.queries import ORACLE, QUERIES


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(contract.oracle_sql())
