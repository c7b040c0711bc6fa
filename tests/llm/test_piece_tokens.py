"""Chunk-wise SentencePiece ids and texts against the library on whole texts."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from curbflow.llm import piece_tokens
from curbflow.llm.idtable import IdTable
from sentencepiece import SentencePieceProcessor

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def odd_texts(seed=0, n=300):
    rng = np.random.default_rng(seed)
    letters = [*"abcdeinrst ABZ  .,'0\t\n▁é", "　", "漢", "𝔘", "\x00", "ﬁ", "  ", "<s>", "<0x0A>", "the ", " of"]
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 120)))) for _ in range(n)]
    return [*texts, "", " ", "  ", "▁", "▁ ▁", "x " * 900, " " * 700, "y" * 3000, "", "ok ", "<unk>", "漢字" * 500]


@pytest.mark.parametrize("step", [1 << 20, 700, 64, 5])
def test_ids_and_texts(library, monkeypatch, step):
    monkeypatch.setattr(piece_tokens, "STEP_BYTES", step)
    table = piece_tokens.PieceTable(MODEL)
    assert table.cuts
    texts = odd_texts()
    got = list(table.encode(pa.array(texts)))
    assert [g.tolist() for g in got] == [library.encode(t, add_eos=True) for t in texts]
    assert [table.decode(g) for g in got] == [library.decode(g.tolist()) for g in got]


def test_table_starts_anew(library, monkeypatch):
    """A full table forgets, and results stay."""
    table = piece_tokens.PieceTable(MODEL)
    monkeypatch.setattr(IdTable, "full", lambda self: self.known > 20)
    monkeypatch.setattr(piece_tokens, "STEP_BYTES", 300)
    texts = odd_texts(1)
    assert [g.tolist() for g in table.encode(pa.array(texts))] == [library.encode(t, add_eos=True) for t in texts]
    assert table.table.known < 400


def test_decodes_any_ids(library):
    """Also ids that no text gives: broken bytes, unknown and control ids anywhere."""
    table = piece_tokens.PieceTable(MODEL)
    rng = np.random.default_rng(2)
    for n in range(400):
        ids = rng.integers(0, [300, 32000][n % 2], int(rng.integers(0, 12)))
        if n % 3 == 0:
            ids = np.concatenate([rng.choice([1, 2, 259, table.alone], 3), ids])
        assert table.decode(ids) == library.decode(ids.tolist()), ids


def test_whole_texts_where_cuts_do_not_hold(library):
    table = piece_tokens.PieceTable(MODEL)
    table.cuts = False
    texts = odd_texts(3, 20)
    assert [g.tolist() for g in table.encode(pa.array(texts))] == [library.encode(t, add_eos=True) for t in texts]


def test_query_on_whole_tables(spark, sf_dir, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, piece_tokens.op11_piece_tokens(spark, sf_dir).collect())) == sorted(want)


def test_edge_cases(spark, library):
    texts = [None, "", "same text", "same text", "w " * 40000, "ü" * 60000]
    rows = [(i if i else None, t, f"{i}") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = piece_tokens.encode(frame, MODEL)
    got = {r["doc_id"]: r["ids"] for r in out.collect()}
    assert got == {i if i else None: library.encode(t or "", add_eos=True) for i, t in enumerate(texts)}
    back = out.select("doc_id", piece_tokens.decode("ids", MODEL).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in back} == {i if i else None: t or "" for i, t in enumerate(texts)}
    assert piece_tokens.encode(frame.limit(0), MODEL).count() == 0
