from pathlib import Path

import pytest

from pyspark.sql import functions as F

from moraine.llm import chat, quality
from tests.llm import test_joins as J


def rendered(rows, perspective):
    text, masks = "", []
    for turn, role, body in rows:
        kind = role if role == "system" else "assistant" if role == perspective else "user"
        head = f"<|user name={role}|>" if kind == "user" else f"<|{kind}|>"
        if kind == "assistant":
            masks.append((len(text) + len(head), len(text) + len(head) + len(body) + len("<|end|>")))
        text += head + body + "<|end|>\n"
    return text, masks


def test_rotation_by_hand(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi 🙂"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 200, None, "x"), (1, None, "ann", "late"), (None, 0, "ann", "alone"), (2, 0, "system", "only")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, perspective string").repartition(3)
    got = chat.rotate(df).collect()
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    order = [(0, "system", "be kind"), (1, "ann", "hi 🙂"), (2, "bob", ""), (2, "bob", ""), (200, "unknown", "x"), (None, "ann", "late")]
    for who in ("ann", "bob", "unknown"):
        own = sorted((r for r in got if r.conv_id == 1 and r.perspective == who), key=lambda r: r.msg)
        text, masks = rendered(order, who)
        assert "".join(r.segment for r in own) == text
        assert [(r.mask_start, r.mask_end) for r in own if r.train] == masks
        assert all(text[r.seg_start : r.seg_end] == r.segment for r in own)
    whole = {(r.conv_id, r.perspective): r for r in chat.rendered(df).collect()}
    assert all((whole[1, who].dialogue, [tuple(m) for m in whole[1, who].masks]) == rendered(order, who) for who in ("ann", "bob", "unknown"))
    assert chat.rotate(df.limit(0)).count() == 0


def test_stages_keep_columns_that_clash(spark, hard_docs, small_sf):
    import corpus_pipeline as P

    labels = spark.createDataFrame([(i, int(i > 3)) for i in range(30)], "doc_id long, quality int")
    hard = hard_docs.withColumn("n_chars", F.length("text").cast("long"))
    scored = quality.score(hard, quality.train(hard, labels, epochs=1, buckets=1 << 10), into="_extra")
    assert scored.select(*hard.columns).exceptAll(hard).count() == 0
    for stage in (P.fresh_lines, P.near_duplicates, P.decontaminated):
        out = stage(spark, hard, small_sf)
        assert out.schema.names == hard.schema.names and out.where("key <> 'key' or _score <> '_score' or _did <> '_did'").count() == 0


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op5_ngram_jaccard_join", "op9_benchmark_decontamination", "op10_embedding_near_dedup"])
def test_against_sql(spark, small_sf, name):
    duckdb = pytest.importorskip("duckdb")
    from moraine.llm import registry

    con = duckdb.connect()
    for t in ("conversations", "documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{small_sf}/{t}.parquet'")
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    df = registry.QUERIES[name](spark, small_sf)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(map(str, r)) for r in cur.fetchall()) == sorted(tuple(str(r[c]) for c in names) for r in df.collect())


def test_pipeline_against_brute_force(spark, small_sf):
    import corpus_pipeline as P
    from moraine.llm.common import stored

    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    columns = docs.columns
    good = stored(P.good_quality(spark, docs, small_sf), "t")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert all(d in kept for d, q in labels.items() if q == 1) and good.columns == columns
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    lines = stored(P.fresh_lines(spark, good, small_sf), "t")
    expected = J.lines_brute(rows)
    got = {r.doc_id: r for r in lines.collect()}
    assert set(got) <= set(expected) and all(r.n_chars == len(r.text) and r.text.strip() for r in got.values())
    import hashlib

    assert all(hashlib.sha256(r.text.encode()).hexdigest() == expected[d][2] for d, r in got.items())
    gone = set(expected) - set(got)
    assert all(expected[d][1] > 0 for d in gone) and lines.columns == columns
    groups = J.near_brute([(d, r.text) for d, r in got.items()], 5, 80)
    one = stored(P.near_duplicates(spark, lines, small_sf), "t")
    assert {r.doc_id for r in one.collect()} == {d for d, g in groups.items() if g[1] == d} and one.columns == columns
    bench = [tuple(r) for r in spark.read.parquet(f"{small_sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = J.leaks_brute([(r.doc_id, r.text) for r in one.collect()], bench)
    clean = stored(P.decontaminated(spark, one, small_sf), "t")
    assert {r.doc_id for r in clean.collect()} == {d for d, v in leaks.items() if not v[4]} and clean.columns == columns
    last = P.run(spark, small_sf)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in clean.collect()}
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=P.sentencepieces.MODEL_PATH)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert all(list(r.ids) == sp.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in last.collect())
    assert Path(P.sentencepieces.MODEL_PATH).exists()
