from collections import defaultdict

import corpus_pipeline
from chartloom.llm import linear, quality, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_decide_and_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before, after = {r.doc_id: r for r in docs.collect()}, {}
        if number < 4:
            assert out.columns == docs.columns
            after = {r.doc_id: r for r in out.collect()}
            assert set(after) <= set(before)
        if name == "quality":
            scored = linear.report(quality.score(docs, quality.train(docs, labels)), quality.THRESHOLD)
            assert set(after) == {r.doc_id for r in scored.where("predicted = 1").collect()}
        elif name == "toxicity":
            scored = linear.report(toxicity.score(docs, toxicity.train(docs, labels)), toxicity.THRESHOLD)
            assert set(after) == {r.doc_id for r in scored.where("predicted = 0").collect()}
        elif name == "simhash":
            groups = simhash.near_duplicates(docs)
            assert set(after) == {r.component_id for r in groups.collect()}
        elif name == "passages":
            assert set(after) == set(before)
            seen = set()
            for i in sorted(before):
                data = before[i].text.encode()
                own = {data[s : s + 50] for s in range(len(data) - 49)}
                changed = after[i].text != before[i].text
                assert changed == bool(own & seen) and after[i].n_chars == len(after[i].text)
                seen |= own
        else:
            sequences = defaultdict(list)
            for r in out.collect():
                sequences[r.sequence_id].append((r.offset, r.length))
            assert {r.doc_id for r in out.collect()} == set(before)
            for parts in sequences.values():
                at = 0
                for offset, length in sorted(parts):
                    assert offset == at
                    at += length
                assert at <= 2048
        docs = out
