"""The whole pipeline over a small table with odd rows, and over an empty one."""

import zlib


import corpus_pipeline
from wharfline.llm import packing

from test_llm_operators import SCHEMA, odd_documents, plain_components, prose



def saved(spark, folder, rows):
    docs = spark.createDataFrame([(*r, "x", "k", 1, 2, 3, 4) for r in rows], SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows if r[0] is not None][:60]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_one_of_each_component_is_packed(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = odd_documents() + [(1000 + k, prose(rng, 40, 5000), "en", f"s{k % 3}", 9) for k in range(60)]
    pieces = corpus_pipeline.run(spark, saved(spark, tmp_path, rows)).collect()
    kept = {p.doc_id for p in pieces}
    assert kept <= {r[0] for r in rows}
    # of each component of similar texts one stays at most, unlinked clean documents stay
    component = {(doc, n): c for doc, n, c in plain_components(rows)}
    linked = {}
    for (doc, _), c in component.items():
        linked.setdefault(c, set()).add(doc)
    single = {next(iter(docs)) for docs in linked.values() if len(docs) == 1}
    weighty = {r[0] for r in rows if r[0] is not None and r[0] >= 1000}
    assert (single & weighty) and len(kept & weighty) > 0.5 * len(single & weighty)
    ids = [r[0] for r in rows]
    texts = {r[0]: r[1] for r in rows if r[0] is not None and ids.count(r[0]) == 1}
    for docs in linked.values():
        assert len([d for d in docs if d in kept and (texts.get(d) or "").strip()]) <= 1
    # sequences have no gap and no padding
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.ids_crc32 == zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in p.ids))
    for own in by.values():
        own.sort()
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert total <= packing.LENGTH and total & (total - 1) == 0


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, saved(spark, tmp_path, [])).collect() == []


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "packing"]
