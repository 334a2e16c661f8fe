"""The corpus pipeline: what each stage keeps, and rows that must pass."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_stages(spark, tmp_path):
    import corpus_pipeline
    from roistack.llm.quality import fit_quality, score_quality

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(1).select(F.lit(10**6).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes[2:]])
    docs = docs.union(odd)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "decontaminate", "tokenize"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        stage(spark, before, sf).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "tokenize":
            assert kept.columns == docs.columns
            assert kept.join(before, "doc_id", "left_anti").count() == 0
        if name == "quality":
            rejected = score_quality(before, fit_quality(before, labels)).where("not keep").select("doc_id")
            assert kept.count() == before.count() - rejected.count()
            good = labels.where("quality = 1").join(kept, "doc_id", "left_anti").count()
            assert good <= 0.02 * labels.count()
        if name == "line_dedup":
            assert kept.count() == before.count()
    assert kept.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name, stage in corpus_pipeline.STAGES[1:3]:
        assert stage(spark, docs.limit(0), sf).count() == 0


def shingles(text):
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_by_brute_force(spark):
    import corpus_pipeline

    rng = random.Random(3)
    base = [[f"w{rng.randrange(4000)}" for _ in range(60)] for _ in range(40)]
    texts = [" ".join(w) for w in base]
    texts += [" ".join(w[:k] + ["new"] + w[k + 1 :]) for w, k in zip(base[:20], range(20), strict=True)]
    texts += [" ".join(w[: 3 * k]) for k, w in enumerate(base[20:30], 10)] + ["", " ", None, "a b", "a b"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r for r in root}) and kept.columns == docs.columns
    # rows without an id: one of each text stays, if no row with an id is near; those without words all stay
    none = docs.where("doc_id in (0, 60, 61, 62, 70, 71, 72)").withColumn("doc_id", F.lit(None).cast("long"))
    fresh = spark.createDataFrame([(None, f"only without an id number {k} here", "en", "s", 1) for k in (1, 1, 2, 1)], docs.schema)
    both = corpus_pipeline.near_duplicates(spark, docs.union(none).union(fresh), "")
    assert sorted(r.doc_id for r in both.where("doc_id is not null").collect()) == sorted({r for r in root})
    assert sorted(str(r.text) for r in both.where("doc_id is null").collect()) == sorted(["", " ", "None", "only without an id number 1 here", "only without an id number 2 here"])


def test_last_stages_by_brute_force(spark):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    joined = lambda t: " ".join(["", *re.findall(r"[a-z0-9\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), ""])
    items = [joined(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = corpus_pipeline.decontaminate(spark, docs, sf).select("doc_id", "text").cache()
    stay = {r.doc_id for r in clean.collect()}
    holds = {i for i, t in texts.items() if any(x in joined(t) for x in items if x.strip())}
    assert holds and not holds & stay and len(stay) >= len(texts) - 2 * len(holds)
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in corpus_pipeline.tokenize(spark, clean, sf).collect():
        ids = np.array(library.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_queries_are_registered():
    entry = pytest.importorskip("__spark_entry__")
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert "op9_jaccard_join" in entry.oracle_sql()
