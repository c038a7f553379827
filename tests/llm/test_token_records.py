import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthfusion.llm import token_records as t
from monthfusion.llm.crc32c import _bytes_table, crc32c

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODING = t.Encoding(PATH, 2)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_checksum_of_any_length():
    assert int(crc32c(np.frombuffer(b"123456789", np.uint8), np.array([0]), np.array([9]))[0]) == 0xE3069283
    data = np.random.default_rng(2).integers(0, 256, 70_000).astype(np.uint8)
    table = _bytes_table()

    def slow(run):
        state = 0xFFFFFFFF
        for x in run.tolist():
            state = int(table[(state ^ x) & 255]) ^ (state >> 8)
        return state ^ 0xFFFFFFFF

    spans = [(0, 4), (3, 259), (1, 257), (5, 70_000), (9, 521)]
    starts, ends = np.array(spans).T
    assert crc32c(data, starts, ends).tolist() == [slow(data[a:b]) for a, b in spans]


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    encode, width = t.encoder(ENCODING)
    random.seed(5)
    parts = ["a", "foo", " ", "  ", "\n", "\t", "'", "'s", "don't", ",", "é", "ß", "½", "_", "-", "23", " ", "́", "中", "😀", "\x1c", "\x85", " Bar", "<|endoftext|>", "​", "\0", "\x0b", "\xa0", "end.", "s;", "größe", "Éa", "ÿñ", "ɏa", "ǆ", "ª", "ı", "$$", "a\nB", "é\n", "#"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(12000)]
    for text, got in zip(texts, encode(texts)):
        assert np.frombuffer(got, width).tolist() == whole(tokenizer, text), text


def expected(tokenizer, rows):
    start, out = 0, []
    for i, text in rows:
        ids = whole(tokenizer, text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_in_id_order(spark, tokenizer, tmp_path):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3, F.rand(1))
    index = t.write_records(spark, df, str(tmp_path / "r"), ENCODING)
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    assert sorted(tuple(r) for r in t.read_files(spark, index).collect()) == expected(tokenizer, rows)
    shuffled = t.read_records(index.orderBy(F.rand(2)).limit(20))
    texts = dict(rows)
    for r in shuffled.collect():
        assert r.ids == whole(tokenizer, texts[r.doc_id])
    assert {str(p.suffix) for p in (tmp_path / "r/records").iterdir()} == {".records"}


def test_awkward_rows(spark, tokenizer, awkward, empty, tmp_path):
    got = t.read_files(spark, t.write_records(spark, awkward, str(tmp_path / "r"), ENCODING)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in awkward.collect()), key=lambda i: -1 if i is None else i)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    sums = sorted(r.ids_crc32 for r in got)
    assert sums == sorted(e[3] for e in expected(tokenizer, [(r.doc_id, r.text) for r in awkward.collect()]))
    assert t.read_files(spark, t.write_records(spark, empty, str(tmp_path / "e"), ENCODING)).count() == 0


def test_damage_is_noticed():
    data = bytearray(b"".join(t.frames([t.NAME.pack(7, 0) + b"abcd" * 40, t.NAME.pack(8, 0) + b"xy"])))
    payloads, used = t.unframe(bytes(data))
    assert used == len(data) and t.payload_ids(payloads[1])[0] == 8
    for at in (0, 9, 30, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            payloads, used = t.unframe(bytes(bad))
            assert used != len(data)
            raise ValueError


def test_a_worker_stays_small_over_many_new_words():
    """Three workers share what an executor has beside its heap."""
    code = """
import resource, pyarrow as pa, public_tokenizers
from monthfusion.llm import token_records as t
from monthfusion.llm.batches import gathered
encode, _ = t.encoder(t.Encoding(public_tokenizers.path("byte_bpe_50k.json"), 2))
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1000
before = peak()
texts = (" ".join("w" + "".join(chr(97 + int(d)) for d in str(k * 1009)) for k in range(n, n + 1000)) for n in range(0, 1_500_000, 1000))
for batch in gathered((pa.record_batch([[text]], ["text"]) for text in texts), t.TEXTS):
    encode(batch.column("text"))
print(peak() - before)
"""
    root = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(done.stdout) < 300
