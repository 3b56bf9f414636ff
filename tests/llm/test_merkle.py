import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from placetally.llm import merkle
from tests.llm.tables import awkward, documents, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    text = row.text if row.text is None or not lower else "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text)
    return sha("".join(field(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def paths_of(digests, fanout):
    """Root and, for each leaf, its siblings level by level, as (left, right)."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), digests
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            first = i // fanout * fanout
            path.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])))
        nodes = [sha("".join(nodes[k:k + fanout])) for k in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def by_rule(rows, fanout=16):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r for r in rows if r.source == source), key=lambda r: (r.doc_id is not None, r.doc_id, leaf_of(r)))
        trees[source] = own, *paths_of([leaf_of(r) for r in own], fanout)
    root, above = paths_of([trees[s][1] for s in sources], fanout)
    out = []
    for source, up in zip(sources, above):
        own, subroot, paths = trees[source]
        for row, path in zip(own, paths):
            way = path + up
            lower = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
            folded = leaf_of(row, lower)
            for a, b in way:
                folded = sha(a + folded + b)
            out.append((row.doc_id, leaf_of(row), subroot, root, sha("".join(a + b for a, b in way)), folded, folded == root))
    return sorted(out, key=repr)


def found(docs, fanout=16):
    return sorted((tuple(r) for r in merkle.manifest(docs, merkle.lower_cased_fifth(), fanout).collect()), key=repr)


@pytest.mark.parametrize("fanout", [2, 3])
def test_trees_of_every_size_by_rule(spark, fanout):
    # blocks are 8 and 27 leaves here, so there are up to 7 rounds, with full and with ragged last subtrees
    rng = random.Random(fanout)
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "e": 130, "f": 343, "é": 65, "g": 17, None: 28}
    rows = [(k * 1_000 + i, prose(rng, 3).title(), "en", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rng.shuffle(rows)
    docs = documents(spark, rows).repartition(5)
    assert found(docs, fanout) == by_rule(docs.collect(), fanout)


def test_awkward_documents(spark):
    docs = awkward(spark, random.Random(1), [(i, "Same Text", "en", "src1") for i in range(40)])
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") % 3 > 0, F.col("n_chars")))
    got = found(docs)
    assert got == by_rule(docs.collect()) and {r[-1] for r in got} == {True, False}
    plain = merkle.manifest(docs).collect()
    assert all(r.verified and r.folded_root == r.root for r in plain) and len({r.root for r in plain}) == 1
    assert merkle.manifest(docs.limit(0)).count() == 0
    one = merkle.manifest(docs.filter("doc_id = 31")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == sha("")


def test_groups_of_the_exchange_are_bounded(spark):
    roots = spark.createDataFrame([("s", b, 37, sha(str(b))) for b in range(37)], "source string, block long, blocks long, digest string")
    out = {r.block: r for r in merkle.butterfly(roots, 4, "test").collect()}
    root, paths = paths_of([sha(str(b)) for b in range(37)], 4)
    assert {r.digest for r in out.values()} == {root}
    assert {b: [tuple(p) for p in r.path] for b, r in out.items()} == dict(enumerate(paths))
