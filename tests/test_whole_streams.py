"""No registered query reads a prefix of its streams."""

from eventweir.plans import registry


def test_sql_has_no_prefix():
    assert not any("pos < 12" in sql for sql in registry.oracle_sql().values())
