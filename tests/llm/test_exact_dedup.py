"""Exact dedup where identifiers repeat, columns differ and groups are too many to broadcast."""

import collections

import pytest


@pytest.mark.parametrize("broadcast_rows", [1 << 19, 0])
@pytest.mark.parametrize("fan_in", [2, 4])
def test_rounds(spark, broadcast_rows, fan_in):
    from eventweir.llm.exact_dedup import drop_exact_copies, exact_dedup

    rows = [(i, f"text {i % 37}" if i % 3 else f"own {i}", f"c{i}") for i in range(400)]
    rows += [(500, "hot", "a")] * 30 + [(501, "hot", "b"), (501, "hot", "a"), (501, "hot", "a"), (None, "hot", "a"), (None, None, "x"), (None, "", "y"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _d string").repartition(7)
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    low = lambda i: -1 if i is None else i
    got = exact_dedup(docs, fan_in=fan_in, broadcast_rows=broadcast_rows).collect()
    want = [(i, max(groups[t or ""], key=low), len(groups[t or ""])) for i, t, _ in rows]
    assert sorted(map(str, ((r["doc_id"], r["keep_id"], r["group_size"]) for r in got))) == sorted(map(str, want))
    assert sum(r["kept"] for r in got) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    left = drop_exact_copies(docs, fan_in=fan_in, broadcast_rows=broadcast_rows)
    kept = left.collect()
    assert left.columns == docs.columns and sorted(r["text"] or "" for r in kept) == sorted(groups)
    assert {r["text"]: r["doc_id"] for r in kept if r["text"]} == {t: max(ids, key=low) for t, ids in groups.items() if t}
    assert sorted(map(str, kept)) == sorted(map(str, drop_exact_copies(docs.repartition(3), fan_in=fan_in, broadcast_rows=broadcast_rows).collect()))
    assert drop_exact_copies(docs.limit(0)).count() == 0


def test_long_texts(spark):
    from eventweir.llm.exact_dedup import exact_dedup

    long = "word " * 1_000_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long + "."), (4, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup(docs).collect()) == [(1, 2, 2), (2, 2, 2), (3, 3, 1), (4, 4, 1)]


def test_fan_in_is_a_power_of_two(spark):
    from eventweir.llm.exact_dedup import exact_dedup

    with pytest.raises(ValueError):
        exact_dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string"), fan_in=3)
