"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from freshet.llm import merkle
from tests.llm.test_operators import DOCS, odd_rows, prose

SF = "/root/testdata/sf0.001"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    cells = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in cells])


def tree(nodes, fanout):
    """The root, and for each node its runs on the way: (place, run)."""
    ways, places, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for way, i in zip(ways, range(len(nodes))):
            way.append((places[i] % fanout, runs[places[i] // fanout]))
            places[i] //= fanout
        level = [H(*r) for r in runs]
    return level[0], ways


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(table, fanout=16):
    sources = {}
    for row in table:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for rows in sources.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in sources[s]], fanout) for s in names}
    root, upper = tree([trees[s][0] for s in names], fanout)
    out = []
    for s, above in zip(names, upper):
        subroot, ways = trees[s]
        for row, way in zip(sources[s], ways):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            at = leaf((row[0], lower(row[1]), *row[2:])) if hit else leaf(row)
            siblings = []
            for place, run in way + above:
                siblings += run[:place] + run[place + 1 :]
                at = H(*run[:place], at, *run[place + 1 :])
            out.append((row[0], leaf(row), subroot, root, H(*siblings), at, at == root))
    return out


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def got(df):
    rows = [(*r, r[-1] == r[3]) for r in map(tuple, df.drop("proof").collect())]
    return sorted(rows, key=key)


@pytest.mark.parametrize("fanout, levels", [(2, 1), (2, 3), (3, 2), (16, 3), (16, 1)])
def test_ragged_trees(spark, fanout, levels):
    # Sources of many sizes: whole powers, one more, one less, one alone; more sources than the fanout.
    sizes = [1, 2, 3, 4, 5, 8, 9, 15, 16, 17, 27, 31, 33, 64, 70, 100, 257, 1]
    table = [(1000 * s + i, f"Text {i} Of {s}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)] + odd_rows()
    docs = spark.createDataFrame(table, DOCS)
    found = merkle.proved(docs, merkle.lower_case, fanout=fanout, leaf_levels=levels)
    assert got(found) == sorted(plain(table, fanout), key=key)


def test_one_row_one_source_and_none(spark):
    assert merkle.proved(spark.createDataFrame([], DOCS)).count() == 0
    row = (7, "One", "en", "a", 3)
    (only,) = merkle.proved(spark.createDataFrame([row], DOCS), merkle.lower_case, whole=True).collect()
    assert only.root == only.subroot == only.leaf == leaf(row) and only.proof == [] and only.proof_sha256 == H()


def test_whole_proofs_lead_to_the_root(spark):
    table = [(i, prose(5, i), "en", "ab"[i % 2], i) for i in range(40)]
    for r in merkle.proved(spark.createDataFrame(table, DOCS), whole=True).collect():
        assert H(*r.proof) == r.proof_sha256 and r.folded_root == r.root
        assert len(r.proof) in (15 + 1 + 1, 3 + 1 + 1)


def test_clashing_columns(spark):
    table = [(i, "T", "en", "a", 1, "x", 5, "y", "z") for i in range(20)]
    docs = spark.createDataFrame(table, DOCS + ", leaf string, _rank int, _key string, node string")
    assert got(merkle.proved(docs, merkle.lower_case)) == sorted(plain([r[:5] for r in table]), key=key)


def test_query_on_the_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = merkle.op13_butterfly_manifest(spark, SF)
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in rows.collect()), key=key) == sorted(plain(table), key=key)
