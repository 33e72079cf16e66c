"""The manifest against trees built in plain Python, for trees of one, several and many pages."""

import hashlib
import zlib

import pytest

from headway.llm import merkle
from headway.llm.queries import QUERIES


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The levels from the leaves up, and every leaf's proof as (side, sibling)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    proofs = []
    for k in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            beside = k ^ 1
            if beside < len(level):
                proof.append(("left" if beside < k else "right", level[beside]))
            else:
                proof.append(("none", ""))
            k //= 2
        proofs.append(proof)
    return levels[-1][0], proofs


def expected(rows):
    by_lang = {}
    for row in rows:
        doc_id, text, lang, source, n_chars = row
        leaf = sha(*map(field, (doc_id, source, lang, n_chars, text)))
        changed = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        now = sha(*map(field, (doc_id, source, lang, n_chars + 1, text))) if changed else leaf
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, now))
    langs = sorted(by_lang, key=lambda lang: b"" if lang is None else b"=" + lang.encode())
    subs = {lang: tree([leaf for _, _, leaf, *_ in sorted(by_lang[lang])]) for lang in langs}
    if not langs:
        return []
    root, above = tree([subs[lang][0] for lang in langs])
    out = []
    for lang, upper in zip(langs, above):
        subroot, proofs = subs[lang]
        for (_, _, leaf, doc_id, now), lower in zip(sorted(by_lang[lang]), proofs):
            folded = now
            for side, sibling in lower + upper:
                folded = sha(sibling, folded) if side == "left" else sha(folded, sibling)
            proof = sha(*(s for _, s in lower + upper))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(spark, docs, levels=merkle.LEVELS):
    df = merkle.prove(merkle.build_manifest(merkle.leaf_rows(docs), levels), spark)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.collect()), key=repr)


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_rows_of_the_table(spark, docs, levels):
    """Small pages make many bands."""
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    want = expected(rows)
    assert found(spark, docs, levels) == want and any(not r[-1] for r in want) and any(r[-1] for r in want)


def test_query(spark, docs, sf_dir):
    got = sorted(map(tuple, QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()), key=repr)
    assert got == expected([tuple(r) for r in docs.select(*COLUMNS).collect()])


def test_odd_rows(spark, odd):
    """Nulls in all columns, repeated rows and ids, texts of any length, columns that clash."""
    rows = [tuple(r) for r in odd.select(*COLUMNS).collect()]
    assert found(spark, odd) == expected(rows)
    assert found(spark, odd.limit(0)) == []
    assert found(spark, odd.filter("doc_id = 3")) == expected([r for r in rows if r[0] == 3])


def test_many_equal_rows_and_languages(spark, monkeypatch):
    """A third of all rows are equal, and there are more languages than a page holds."""
    monkeypatch.setattr(merkle, "TASK_ROWS", 16)
    rows = [(7, "same", "en", None, 4)] * 40 + [(k, f"t{k}", f"l{k % 23}", "s", k) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(spark, df, 2) == expected(rows)


def test_records_lead_from_the_root_to_all_leaves(spark, docs):
    manifest = merkle.build_manifest(merkle.leaf_rows(docs))
    records = {r.digest: r.children for r in manifest.records().collect()}
    assert all(merkle.digest_of(children) == digest for digest, children in records.items())
    level, leaves = [manifest.root()], set()
    while level:
        leaves |= {d for d in level if d not in records}
        level = [c for d in level for c in records.get(d, [])]
    assert leaves == {r.leaf for r in merkle.leaf_rows(docs).collect()}


def test_paths_fold_back(spark, docs):
    manifest = merkle.build_manifest(merkle.leaf_rows(docs))
    for row in merkle.prove(manifest, spark, paths=True).limit(50).collect():
        assert merkle.fold(row.leaf, row.path) == row.root == manifest.root()
        assert merkle.digest_of(merkle.siblings_of(row.path)) == row.proof_sha256
