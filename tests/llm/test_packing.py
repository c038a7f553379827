import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from monthfusion.llm import packing as p
from monthfusion.llm.pieces import PieceIds
from monthfusion.llm.token_records import Encoding

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODING = Encoding(PATH, 1)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_plan_cuts_every_length_into_few_pieces_that_fill_their_class():
    cuts = p.plan(2048)
    assert all(sum(c) == n for n, c in enumerate(cuts)) and max(map(len, cuts)) <= 4
    for c in cuts:
        for length in c:
            k = 2048 // length
            assert 2048 - k * length <= p.SLACK or length < p.SHORT or length == 2048 // k


def test_words_alone_have_the_ids_of_whole_texts(tokenizer):
    rng = np.random.default_rng(3)
    parts = ["a", "Foo", " ", "  ", "\n", "\t", "\x0b", "'", "'S", "don't", ",", "é", "é", "́", "ß", "½", "_", "-", "23", "\xa0", "中", "😀", "\x1c", "\x85", "Σ", "<|endoftext|>", "<|ENDOFTEXT|>", "The,", "End.", ".", "ok?", "İ", "K", "größe", "ñandú", "Été", "ÿ", "ǆ", "µm", "ªa", "$$", "a#", "é*", "×", "a.b", "'re!"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(3000)] + [None]
    words = PieceIds(PATH, p.WORD)
    for text, got in zip(texts, p.document_ids(words, pa.array(texts), 1), strict=True):
        assert np.frombuffer(got, words.width).tolist() == whole(tokenizer, text), text


def test_forgotten_words_are_learnt_again(tokenizer, monkeypatch):
    monkeypatch.setattr("monthfusion.llm.pieces.KEPT", 3)
    words = PieceIds(PATH, p.WORD)
    for k in range(20):
        text = " ".join(f"w{j}x {j}" for j in range(k % 7))
        assert np.frombuffer(p.document_ids(words, pa.array([text]), 1)[0], words.width).tolist() == whole(tokenizer, text)


def check(spark, tokenizer, df, folder):
    """Every id lies in one piece, sequences are gapless, full bins are of one class."""
    sequences = p.write_sequences(spark, df, str(folder), ENCODING)
    at = defaultdict(list)
    for s in sequences.collect():
        ids = np.frombuffer(s.ids, "<u2").tolist()
        assert len(ids) == s.n_tokens <= 2048 and s.padded_to in (s.n_tokens, 2048)
        assert (s.padded_to == s.n_tokens) == (bin(s.n_tokens).count("1") == 1)
        end = 0
        for x in s.pieces:
            assert x.offset == end and x.length > 0
            end += x.length
            at[x.doc_id, x.doc_tokens].append((x.start, ids[x.offset : end]))
        assert end == s.n_tokens
    documents = defaultdict(Counter)
    for r in df.select("doc_id", "text").collect():
        ids = whole(tokenizer, r.text)
        documents[r.doc_id, len(ids)].update((i, x) for i, x in enumerate(ids))
    for key, pieces in at.items():
        assert Counter((start + i, x) for start, ids in pieces for i, x in enumerate(ids)) == documents.pop(key)
    assert not documents
    rows = p.read_pieces(sequences, ENCODING).collect()
    sums = Counter((i, start, zlib.crc32(np.array(ids, "<u4").tobytes())) for (i, _), pieces in at.items() for start, ids in pieces)
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in rows) == sums
    return sequences


def test_round_trip_and_little_padding(spark, tokenizer, tmp_path):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    sequences = check(spark, tokenizer, df, tmp_path / "s")
    n, padded = sequences.selectExpr("sum(n_tokens)", "sum(padded_to)").first()
    assert padded <= 1.005 * n


def test_bins_take_a_fixed_count_of_their_class():
    bins = p.Bins(2048, 1)
    lengths = [700] * 50 + [1000] * 40 + [5000] * 30 + [40] * 60 + [3] * 700
    full = [s for k, n in enumerate(lengths) for s in bins.add(k, bytes(n))]
    for s in full:
        assert {2048 // x[2] for x in s} == {len(s)} and sum(x[2] for x in s) >= 2048 - p.SHORT
    rest = list(bins.rest())
    assert sum(x[2] for s in full + rest for x in s) == sum(lengths)
    sizes = [sum(x[2] for x in s) for s in rest]
    assert all(bin(n).count("1") == 1 for n in sizes) and sizes == sorted(sizes, reverse=True)


def test_awkward_rows(spark, tokenizer, awkward, empty, tmp_path):
    check(spark, tokenizer, awkward, tmp_path / "a")
    assert p.read_pieces(p.write_sequences(spark, empty, str(tmp_path / "e"), ENCODING), ENCODING).count() == 0
    with pytest.raises(ValueError):
        p.write_sequences(spark, awkward, str(tmp_path / "x"), ENCODING, capacity=1000)
