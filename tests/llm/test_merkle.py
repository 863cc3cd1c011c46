import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import catalog, merkle
from tests.conftest import SF_SMALL

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def _path(levels, i, arity):
    out = []
    for row in levels[:-1]:
        s = i // arity * arity
        out.append((row[s:i], row[i + 1:s + arity]))
        i //= arity
    return out


def _brute(rows, arity=2):
    """Every row's ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``."""
    by_lang = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = _h(*map(_field, (doc_id, source, lang, n_chars, text)))
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        other = _h(*map(_field, (doc_id, source, lang, n_chars + 1, text))) if hit else leaf
        by_lang[lang].append((doc_id, leaf, other))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by_lang[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {x: _tree([r[1] for r in by_lang[x]], arity) for x in langs}
    top = _tree([trees[x][-1][0] for x in langs], arity) if langs else None
    out = []
    for at, x in enumerate(langs):
        for i, (doc_id, leaf, value) in enumerate(by_lang[x]):
            path = _path(trees[x], i, arity) + _path(top, at, arity)
            for left, right in path:
                value = _h(*left, value, *right)
            proof = _h(*[s for left, right in path for s in left + right])
            out.append((doc_id, leaf, trees[x][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=str)


def _digests(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256),
                                               "folded_root", "verified").collect()), key=str)


def _rows():
    rows = [(i, f"s{i % 3}", ["en", "en", "en", "de", None, "Ö", "fr"][i % 7], None if i % 11 == 0 else i, f"té {i}\n") for i in range(150)]
    return rows + [(3, None, None, None, None), (3, "a", "en", 1, "x"), (3, "a", "en", 1, "x"), (None, "", "", 2 ** 62, ""),
                   (None, None, "en", 5, "y"), (-4, "lone", "zz", 2 ** 63 - 1, "t" * 100_000)]


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = catalog.QUERIES["op12_merkle_manifest"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows)
    assert 0 < sum(not r.verified for r in got) < len(rows)


@pytest.mark.parametrize("block", [4096, 8, 2])
def test_blocks_rounds_nulls_ties_and_long_texts(spark, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    assert _digests(merkle.document_manifest(spark.createDataFrame(_rows(), SCHEMA))) == _brute(_rows())


def test_full_blocks_and_hot_group(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, "s", "en", i, "x") for i in range(64)] + [(100 + i, "s", "de", i, "x") for i in range(8)] + [(200, "s", "fr", 1, "x")]
    assert _digests(merkle.document_manifest(spark.createDataFrame(rows, SCHEMA).repartition(13))) == _brute(rows)


def test_other_arity_columns_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 27)
    docs = spark.createDataFrame(_rows(), SCHEMA).withColumns({"leaf": F.lit(1), "pos": F.lit("p"), "g": F.lit(0), "root": F.lit(None)})
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    rule = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    got = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], arity=3, replace={"n_chars": more}, where=rule)
    assert _digests(got) == _brute(_rows(), 3)
    assert merkle.document_manifest(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(docs, ["doc_id"], arity=1)


def test_fold_resumes_the_state_before_the_slot():
    children = [_h(str(i)) for i in range(5)]
    parent = merkle.Parent(children)
    assert parent.digest == _h(*children) and len(parent.states) == 5
    for slot in range(5):
        assert parent.fold(slot, "r") == _h(*children[:slot], "r", *children[slot + 1:])
        assert parent.fold(slot, children[slot]) == parent.digest


def test_untampered_rows_verify(spark):
    out = merkle.manifest(spark.createDataFrame(_rows(), SCHEMA), ["doc_id", "text"]).collect()
    assert len(out) == len(_rows()) and all(r.verified and not r.replaced for r in out)
