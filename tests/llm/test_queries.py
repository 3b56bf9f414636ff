import pytest

import corpus_pipeline
from checks.compare import _rows, oracle_connection
from placetally.llm.common import stored
from placetally.llm.queries import ORACLES, QUERIES
from tests.llm.test_decontamination import by_rule as contaminated
from tests.llm.test_simhash import by_rule as fingerprint
from tests.llm.test_simhash import components_by_rule
from tests.llm.test_substring_dedup import by_rule as repeats

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    cursor = oracle_connection(SF_DIR).execute(ORACLES[name])
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    assert _rows(found.columns, found.collect()) == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_covers_its_table(spark, name):
    table = "pages" if "html" in name else "documents"
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_pipeline_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        old, new = {r.doc_id: r for r in before.collect()}, docs.collect()
        assert {r.doc_id for r in new} <= set(old) and docs.columns[: len(columns)] == columns
        ids = sorted(old)
        if name == "simhash":
            bits = [fingerprint(old[i].text) for i in ids]
            near = [(a, b) for a in range(len(ids)) for b in range(a) if (bits[a] ^ bits[b]).bit_count() <= 3]
            root = components_by_rule(bits, near)
            assert sorted(r.doc_id for r in new) == [i for k, i in enumerate(ids) if root[k] == k]
        elif name == "substring_dedup":
            lost = {i: gone for i, _, gone, _ in repeats([(i, old[i].text) for i in ids])}
            assert {r.doc_id: len(old[r.doc_id].text.split()) - len(r.text.split()) for r in new} == {
                i: n for i, n in lost.items() if n == 0 or n < len(old[i].text.split())}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
            hit = {i for i, _, n, _ in contaminated([(i, old[i].text) for i in ids], items) if n}
            assert {r.doc_id for r in new} == set(old) - hit and hit
        elif name == "mixing":
            assert len(new) > len(old) and max(r["copy"] for r in new) == 2
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()
