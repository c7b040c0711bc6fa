"""Delta-maintained token totals against plain recounts."""

from collections import Counter

import public_tokenizers
from curbflow.llm import token_counts
from tokenizers import Tokenizer

SCHEMA = "change_id long, op string, source string, lang string, tokenizer string, n_tokens long, old_n_tokens long, d_docs string"


def totals(ledger):
    return sorted((tuple(r) for r in ledger.totals().collect()), key=repr)


def test_query_on_whole_tables(spark, sf_dir):
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    want, seen = Counter(), set()
    for r in docs:
        if r["text"] not in seen:
            seen.add(r["text"])
            key = (r["source"], r["lang"], "word_bpe_49k.json")
            want[(*key, 0)] += 1
            want[(*key, 1)] += len(bpe.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    got = {tuple(r)[:3]: tuple(r)[3:] for r in token_counts.op1_token_counts(spark, sf_dir).collect()}
    assert got == {k[:3]: (want[(*k[:3], 0)], want[(*k[:3], 1)]) for k in want if k[3] == 0}


def test_null_texts_and_ids(spark, tmp_path):
    rows = [(1, "s", "en", None), (2, "s", "en", None), (3, "s", "en", ""), (None, "t", "en", "one"), (None, "t", "en", "one"), (4, "u", "en", "two"), (None, "u", "en", "two")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    one, two = (len(bpe.encode(t, add_special_tokens=False).ids) for t in ("one", "two"))
    got = sorted(tuple(r) for r in token_counts.op1_token_counts(spark, str(tmp_path)).collect())
    name = "word_bpe_49k.json"
    assert got == [("s", "en", name, 2, 2), ("t", "en", name, 2, 2 * one + 2), ("u", "en", name, 1, two + 1)]


def test_batches_are_applied_once_and_in_any_order(spark, tmp_path):
    first = spark.createDataFrame(
        [
            (1, "insert", "s", "en", "v1", 10, None, "x"), (1, "insert", "s", "en", "v1", 10, None, "x"), (2, "insert", None, None, "v1", None, None, "x"),
            (3, "insert", "s", "en", "v2", 7, None, "x"), (None, "insert", "s", "en", "v1", 5, None, "x"), (None, "insert", "s", "en", "v1", 5, None, "x"),
            (4, "other", "s", "en", "v1", 99, None, "x"), (5, None, "s", "en", "v1", 99, None, "x"),
        ], SCHEMA,
    )
    second = spark.createDataFrame([(1, "revise", "s", "en", "v1", 12, 10, "x"), (3, "delete", "s", "en", "v2", 7, None, "x")], SCHEMA)
    want = [("s", "en", "v1", 3, 22), (None, None, "v1", 1, 0)]
    for name, order in (("a", (first, second)), ("b", (second, first))):
        ledger = token_counts.TokenLedger(spark, str(tmp_path / name))
        assert totals(ledger) == []
        for changes in order:
            batch = "1/x" if changes is first else "2"
            assert ledger.commit(batch, changes)
            assert not ledger.commit(batch, changes)
        assert ledger.commit("empty", first.limit(0))
        assert totals(ledger) == want


def test_counts_of_odd_texts(spark):
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", "It's <|endoftext|> x", "J̌ é́ ﬁ İ", "a" * 3000, "don't..stop\x0b\x1cnow 日本語 12345"]
    frame = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = [r["n_tokens"] for r in sorted(token_counts.count_tokens(frame, public_tokenizers.path("word_bpe_49k.json")).collect(), key=lambda r: r["row"]["doc_id"])]
    assert got == [len(bpe.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_contradicting_rows_in_any_order(spark, tmp_path):
    """Rows of one id that contradict each other, in a batch or in the documents, give one result."""
    rows = [(5, "insert", "a", "en", "v1", 10, None, "x"), (5, "insert", "b", "en", "v1", 3, None, "x")]
    found = {tuple(map(tuple, token_counts.signed(spark.createDataFrame(r, SCHEMA).coalesce(1)).collect())) for r in (rows, rows[::-1])}
    assert found == {(("b", "en", "v1", 1, 3),)}
    docs = [(1, "s", "en", "one"), (2, "s", "en", "one"), (2, "s", "en", "two words"), (3, "s", "en", "two words")]
    got = set()
    for k, order in enumerate((docs, docs[::-1])):
        path = str(tmp_path / f"{k}")
        spark.createDataFrame(order, "doc_id long, source string, lang string, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
        got.add(tuple(tuple(r) for r in token_counts.op1_token_counts(spark, path).collect()))
    assert len(got) == 1 and next(iter(got))[0][3] in (2, 3)
