"""The pipeline's stages against the operators' brute-force versions, stage by stage."""

import corpus_pipeline
import public_tokenizers
from llm_brute import decontam_brute, line_brute, minhash_brute
from tokenizers import Tokenizer


def table(frame):
    return {r["doc_id"]: r.asDict() for r in frame.collect()}


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = table(docs)
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = before
        pairs = sorted((d, r["text"]) for d, r in before.items())
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            kept = set(table(docs))
            clean = [d for d, t in labels.items() if t == 0]
            assert sum(d in kept for d in clean) >= 0.97 * len(clean)
            assert all(r == before[d] for d, r in table(docs).items())
        elif name == "line_dedup":
            want = {d: t for d, t, gone in line_brute(pairs, 10) if not (gone and not t.strip())}
            assert {d: r["text"] for d, r in table(docs).items()} == want
        elif name == "near_dedup":
            assert set(table(docs)) == {d for d, _, _, kept in minhash_brute(pairs, 80) if kept}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(table(docs)) == {r[0] for r in decontam_brute(pairs, items) if not r[-1]}
        else:
            bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            ids = {}
            for r in sorted(docs.collect(), key=lambda r: (r["doc_id"], r["start"])):
                ids[r["doc_id"]] = ids.get(r["doc_id"], b"") + bytes(r["ids"])
            assert {d: len(b) // 4 for d, b in ids.items()} == {d: len(bpe.encode(t, add_special_tokens=False).ids) + 1 for d, t in pairs}


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
