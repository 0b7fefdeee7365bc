"""The stages one after another, each on its own input, and the registered queries' columns."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from almanac.llm import mixing, packing
from almanac.llm.queries import ORACLES, QUERIES, VOCABULARY
from almanac.sources.files import subfolders
from almanac.sources.stage import stage, stage_folder
from check import connect

from .conftest import SMALL, WORD
from .test_near_dedup import groups


def test_stages(spark, small):
    docs, results = small, {}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        results[name] = docs = stage(apply(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == small.columns
    whole = {r.doc_id: r.text for r in small.collect()}
    calm = {r.doc_id: r.text for r in results["toxicity"].collect()}
    assert 0.7 * len(whole) < len(calm) <= len(whole) and all(whole[i] == t for i, t in calm.items())
    labels, _ = groups(calm)
    assert {r.doc_id for r in results["near_dedup"].collect()} == set(labels.values())
    masked = {r.doc_id: r.text for r in results["secrets"].collect()}
    assert set(masked) == set(labels.values()) and not any('token = "0' in t for t in masked.values())
    assert sum(a != calm[i] for i, a in masked.items()) == sum("[SECRET]" in t for t in masked.values())
    mixed = results["mixing"].collect()
    assert {r.doc_id for r in mixed} <= set(masked)
    total, given = sum(len(WORD.findall(r.text)) for r in mixed), sum(len(WORD.findall(t)) for t in masked.values())
    assert abs(total - given) < 0.05 * given
    pieces = corpus_pipeline.STAGES[-1][1](spark, results["mixing"], SMALL).collect()
    assert sum(r.length for r in pieces if r.start == 0) and {r.doc_id for r in pieces} == {r.doc_id for r in mixed}
    folders = set(subfolders(spark, stage_folder(spark)))
    whole = corpus_pipeline.run(spark, SMALL)
    assert len(set(subfolders(spark, stage_folder(spark))) - folders) == 2  # the last result, and the pieces that are read lazily
    assert sorted(map(str, whole.collect())) == sorted(map(str, pieces))


def test_sequences_of_the_pipeline_hold_the_librarys_ids(spark):
    """Texts of the mix, encoded by the library, are what the packed sequences hold, piece by piece."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mixed = stage(mixing.mixed_documents(docs), "mixed")
    packed = stage(packing.pack_documents(mixed, public_tokenizers.path(VOCABULARY), with_ids=True), "packed")
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    want = Counter((r.doc_id, tuple([*library.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID])) for r in mixed.collect())
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    rows = packed.collect()
    assert all(list(r.ids) == sequences[r.sequence_id][r.offset : r.offset + r.length] for r in rows)
    texts = {}
    for r in sorted(rows, key=lambda r: r.start):
        texts.setdefault((r.doc_id, r.document, r.doc_tokens), {}).setdefault(r.start, []).append(tuple(r.ids))
    got = Counter()
    for (doc_id, _, n), parts in texts.items():
        ids = tuple(i for start in sorted(parts) for i in parts[start][0])
        assert len(ids) == n and all(len(set(p)) == 1 for p in parts.values())
        got[doc_id, ids] += len(parts[0])
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_every_row(spark, name):
    table = {"op7": "pages", "op11": "benchmark", "op12": "conversations", "op13": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet")
    rows = rows.select("conv_id").distinct().count() + name.startswith("op13") if table == "conversations" else rows.count()
    got = QUERIES[name](spark, SMALL).count()
    assert got == 10 * rows if name.startswith("op11") else got > 0 if name.startswith("op3") else got >= rows if name.startswith("op6") else got == rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_give_the_rows_of_their_sql(spark, name):
    con = connect(SMALL)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    rows = QUERIES[name](spark, SMALL)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted(map(tuple, rows.select(*columns).collect())) == sorted(cursor.fetchall())
