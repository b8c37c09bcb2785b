import hashlib
import struct

import corpus_pipeline
from ledgerlens.llm import bpe, decontamination, quality_rules, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if k < 5 else {}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns == columns or k == 4
        kept.append((before, docs, after))
        docs = after
    ids = [{r.doc_id for r in after.select("doc_id").collect()} for _, _, after in kept]
    model = toxicity.train(kept[0][1], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids[0] == {d for d, t in kept[0][0].items() if model.score(t) < toxicity.THRESHOLD}
    assert ids[1] == {d for d, t in kept[1][0].items() if not any(eval(rule, {}, dict(zip(quality_rules.MEASURES, quality_rules.measure(t), strict=True))) for rule in quality_rules.RULES.values())}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, t in kept[2][0].items() for w in [t.lower().split()]}
    lead = {d: d for d in sets}
    for a in sorted(sets):  # smallest reachable, by passing labels on until nothing moves
        lead[a] = min([a, *(b for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))])
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                if lead[b] < lead[a] and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    lead[a], moved = lead[b], True
    assert ids[2] == {d for d in sets if lead[d] == d}
    items = [(r.item_id, "".join(c for c in r.text.lower() if c.isalnum())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {d for d, t in kept[3][0].items() if any(x in "".join(c for c in t.lower() if c.isalnum()) for _, x in items)}
    index = decontamination.Index([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert not ids[3] & whole and ids[3] == {d for d, t in kept[3][0].items() if not index.find(t)}
    encoder = bpe.Encoder(bpe.multi_vocabulary())
    for r in docs.collect():
        got = encoder.encode(kept[4][0][r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(got), hashlib.sha256(struct.pack(f"<{len(got)}I", *got)).hexdigest(), hashlib.sha256(kept[4][0][r.doc_id].encode()).hexdigest())


ODD = "doc_id long, text string, lang string, source string, n_chars long, _entry string, _n string, _row int, spans int, kept int"


def test_stages_take_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, further columns of names that the stages use, and no rows at all."""
    texts = [None, "", " ", "a", "word " * 3000, "plain words stand here one after the other " * 4, "plain words stand here one after the other " * 4, "x" * 200_000]
    rows = [(k if k != 7 else None, t, None, None, None, "e", "n", 1, 2, 3) for k, t in enumerate(texts)] + [(5, texts[5], None, None, None, "e", "n", 1, 2, 3)]
    docs = spark.createDataFrame(rows, ODD)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs, SF)
        assert k == 4 or got.columns == docs.columns, name
        ids = sorted((r.doc_id for r in got.collect()), key=str)
        if name in ("toxicity", "decontamination", "byte_bpe"):
            assert ids == sorted((r[0] for r in rows), key=str), name
        elif name == "near_dedup":
            assert ids == sorted([0, 1, 2, 3, 4, 5, None], key=str)
        else:
            assert set(ids) <= {r[0] for r in rows}
        assert stage(spark, docs.where("false"), SF).count() == 0, name


def test_all_stages_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and docs.count() == 0
