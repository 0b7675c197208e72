import random

import corpus_pipeline
from corpus_pipeline import STAGES, run
from pyspark.sql import functions as F
from tests.llm.test_near_dedup import brute as brute_classes
from tests.llm.test_placing import law_holds

SF = "/root/testdata/sf0.01"


def through(spark, docs, sf, tmp_path):
    out = [docs]
    for name, stage in STAGES[:-1]:
        stage(spark, out[-1], sf).write.parquet(f"{tmp_path}/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return out, STAGES[-1][1](spark, out[-1], sf).collect()


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps, shards = through(spark, docs, SF, tmp_path)
    kept = [{r.doc_id: r.text for r in s.collect()} for s in steps]
    assert all(s.columns == docs.columns for s in steps)
    assert len(kept[1]) >= 0.99 * len(kept[0])
    classes = brute_classes(list(kept[1].items()), 5, 80)
    assert set(kept[2]) == {i for i, (_, c) in classes.items() if c == i}
    words = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.casefold()).split())
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i, t in kept[2].items() if any(f" {x} " in f" {words(t)} " for x in items)}
    gone = set(kept[2]) - set(kept[3])
    assert exact and exact <= gone and len(gone) <= 1.2 * len(exact) + 3
    assert kept[4] == kept[3]
    law_holds(shards, 16, len(kept[4]))
    # slots follow the order of the mix
    place = {r.doc_id: k for k, r in enumerate(sorted(
        steps[4].select("doc_id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).collect(),
        key=lambda r: (r.f, r.i)))}
    for k in range(16):
        order = [place[r.doc_id] for r in sorted((r for r in shards if r.shard == k), key=lambda r: r.slot)]
        assert order == sorted(order)


def test_languages_are_rejected_alike_for_any_number_of_them(spark):
    def word(rng, k):      # language k has letters of its own among shared ones
        return "".join(rng.choice([chr(0x4E00 + 8 * k + rng.randrange(8)), rng.choice("abcdefgh")]) for _ in range(6))

    schema = "doc_id long, text string, lang string"
    for languages in (1, 2, 4, 40):
        rng = random.Random(languages)
        rows = [(k * 20 + i, " ".join(word(rng, k) for _ in range(60)), f"l{k:02d}") for k in range(languages) for i in range(20)]
        short = [(10_000 + k, " ".join(word(rng, k) for _ in range(4)), None) for k in range(languages)]
        junk = [(20_000, "щжыэ юяфц ъьчш", None)]
        left = {r.doc_id for r in corpus_pipeline.language_id(spark, spark.createDataFrame(rows + short + junk, schema), SF).collect()}
        assert left == {r[0] for r in rows + short}


def test_run_writes_the_stages(spark):
    rows = run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "shard", "slot"} <= set(rows[0].asDict())
    assert corpus_pipeline.ORACLE_SQL is None and len(STAGES) == 5


def test_hostile_documents_and_none(spark, hostile, no_docs, tmp_path):
    plain = hostile.select("doc_id", "text", "lang", "source", "n_chars", "label", "shard")
    steps, shards = through(spark, plain, "/root/testdata/sf0.001", tmp_path / "a")
    assert [s.columns for s in steps] == [plain.columns] * 5
    assert sorted(r.doc_id or 0 for r in steps[1].collect()) == [0, 1, 1, 2, 7, 8, 9, 10]
    assert sorted(r.doc_id or 0 for r in steps[2].collect()) == [1, 7, 8, 9, 10]      # the copy without id is gone
    law_holds(shards, 16, 5)
    steps, shards = through(spark, no_docs.select(plain.columns), "/root/testdata/sf0.001", tmp_path / "b")
    assert shards == [] and all(s.count() == 0 for s in steps)


def test_rows_without_id_are_judged_by_their_text(spark):
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    clean = "The miller counted his sacks of grain beside the old stone bridge while the river rose."
    other = "Nobody on the hill had seen the grey mare since the fair, and the stable door stood open."
    rows = [(None, f"Some words before. {items[0]} And some after.", "en", "a", 1), (None, clean, "en", "a", 1), (5, other, "en", "a", 1),
            (5, f"{items[1]} under an id that a clean text has", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.decontaminate(spark, docs, "/root/testdata/sf0.001").collect()
    assert sorted(r.text for r in left) == sorted([clean, other])
    again = docs.where("doc_id is null").unionByName(docs).unionByName(
        spark.createDataFrame([(9, clean, "en", "b", 1)], docs.schema))
    kept = corpus_pipeline.near_dedup(spark, again, SF).collect()
    texts = [r.text for r in kept]
    assert len(set(texts)) == len(texts) == 4                    # copies without id are gone, two texts under one id stay
    assert [r.doc_id for r in kept if r.text == clean] == [9]


def test_rows_without_id_are_mixed_like_any_others(spark, tmp_path):
    rows = [(None if i < 400 else i, f"text {i % 37}", "en", "a" if i < 600 else "b", "clash") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_place string").repartition(5)
    for frame in (docs, None):
        if frame is None:
            docs.write.parquet(f"{tmp_path}/in")
            frame = spark.read.parquet(f"{tmp_path}/in")
        corpus_pipeline.mix_sources(spark, frame, SF).write.parquet(f"{tmp_path}/{frame is docs}")
        got = spark.read.parquet(f"{tmp_path}/{frame is docs}").withColumns({"f": F.col("_metadata.file_name"), "i": F.col("_metadata.row_index")})
        order = [(r.doc_id, r.source) for r in sorted(got.collect(), key=lambda r: (r.f, r.i))]
        assert len(order) == 1200 and got.columns[:5] == docs.columns
        at = [k for k, (i, _) in enumerate(order) if i is None]
        assert len(at) == 400 and max(at) - min(at) >= 700        # one source's rows: they alternate with the other's blocks
        for lo in range(0, 1200 - 64, 64):                        # blocks of 32 of either source all along
            assert {s for _, s in order[lo:lo + 64]} == {"a", "b"}
