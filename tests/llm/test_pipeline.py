"""The pipeline on a small corpus with planted cases."""

import random

import corpus_pipeline


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    words = {"en": "the and of that with ing tion er".split(), "de": "der die und ung keit sch ein zu".split()}
    text = lambda lang, n=80: " ".join("".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    item = text("en", 25)
    rows = [(k, text("en" if k % 2 else "de"), "en" if k % 2 else "de", "s", 1) for k in range(60)]
    rows += [(100, rows[7][1], "en", "s", 1), (101, rows[8][1] + " zu", "de", "s", 1), (102, text("en", 30) + " " + item, "en", "s", 1), (103, "xqzj vkwq " * 60, "en", "s", 1), (104, None, "en", "s", 1), (105, text("en") + " a.b@c.de", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        if name != "packing":
            assert kept.columns == docs.columns
        seen[name] = {r.doc_id for r in kept.collect()}
        if name == "pii":
            assert [r.text[-8:] for r in kept.where("doc_id = 105").collect()] == [" [EMAIL]"]
    clean = set(range(60)) | {105}
    assert seen["language_id"] == clean | {100, 101, 102}
    assert seen["simhash_near_dedup"] == clean | {102}
    assert seen["decontamination"] == seen["pii"] == seen["packing"] == clean
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == clean
