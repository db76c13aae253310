import re

import corpus_pipeline
from roadlens.llm import queries


def test_stages_in_order_and_columns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, sf_small).cache()
        assert made.columns == columns + ["token_ids"] * (k == 4)
        n = made.count()
        if name == "near_duplicates":
            assert made.select("doc_id").distinct().count() == n
        if name == "personal_data":
            assert n == docs.count() and not made.where(r"text rlike '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\\.[A-Za-z0-9-]+'").count()
        docs = made
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixture", "tokens"]


def test_all_numbered_queries_are_registered(spark, sf_small):
    numbers = sorted(int(m[1]) for n in queries.QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES and set(queries.ORACLES) <= set(queries.QUERIES)



def test_run_is_its_stages_and_takes_an_empty_table(spark, sf_small, tmp_path):
    from pyspark.sql import functions as F

    from roadlens.llm import mixing, pii, quality_gam, simhash

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = docs.limit(6).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(5000).cast("long")).withColumn("text", F.lit(None).cast("string")))
    folder = str(tmp_path / "some")
    docs.unionByName(odd).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder).collect()

    # the decisions of each stage from the operators' own reports, applied in plain Python
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    said = quality_gam.classify(docs, labels).collect()
    good = {r.doc_id for r in said if r.predicted == 1}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).collect()} == good
    kept = docs.where(F.col("doc_id").isin([i for i in good if i is not None]))
    groups = {}
    for r in simhash.near_duplicates(kept, shingle=3, max_distance=2).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    one = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert sorted(r.doc_id for r in one.collect()) == sorted(map(min, groups.values()))
    spans = {r.doc_id: r for r in pii.find_spans(one).collect()}
    clean = corpus_pipeline.personal_data(spark, one, folder).cache()
    assert clean.count() == len(spans)
    for r in clean.collect():
        text, at, out = spans[r.doc_id].text, 0, ""
        for start, kind, end in spans[r.doc_id].spans:
            if start >= at:
                out += text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, end)
        assert (r.text or "") == out + text[at:] and (r.text is None or r.n_chars == len(r.text))
    from roadlens.llm.queries import quality_weights

    taken = {r.doc_id: r.taken for r in mixing.mix(clean, quality_weights(spark, folder)).collect()}
    mixed = {}
    for r in corpus_pipeline.mixture(spark, clean, folder).collect():
        mixed[r.doc_id] = mixed.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert mixed == {i: n for i, n in taken.items() if n}
    assert got and all(r.token_ids is not None for r in got)

    empty = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    labels.write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
