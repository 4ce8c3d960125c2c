import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from celltrace.llm import encoders, files, token_counts, tokenfiles
from celltrace.llm.scratch import Scratch
from tests.llm.helpers import DOCS, nothing, twins, with_clashes

WORD, PIECE, BYTE = (str(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"))
ODD = ["a", "É", "é", "́", "ſ", "İ", "Σς", "'s", "'", "’", "5", "²", "Ⅷ", "\t", " ", " ", "\n", "  ", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "<|", "|>",
       "😀", "‍", "中", "\x00", "\x1c", ".", "!!", "_", "ﬁ", "Ǆ", "\r", "１", "×", "÷", "Ã", "\x0b", "\x0c", "abc", "ABC", "　", "</s>", "▁"]


def texts(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + [None, "", "x" * 300_000, "y " * 200_000, "Word, word. WORD!! word's"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_json_ids_equal_the_library(path, monkeypatch):
    monkeypatch.setattr(encoders, "STORED_PIECES", 500)  # the store starts anew several times
    column = pa.array(texts(1, 3000))
    tool = Tokenizer.from_file(path)
    expected = [e.ids for e in tool.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)]
    made = encoders.JsonEncoder(path)
    assert made.by_piece == (path == WORD)
    for at in range(0, len(column), 400):
        ids, ends = made.encode_column(column.slice(at, 400))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == expected[at : at + 400]
    assert made.encode_column(pa.array([], pa.string()))[1].tolist() == [0]


def test_words_with_one_polynomial_value(monkeypatch):
    column = [w for n in (6, 10, 12) for w in twins(n)]
    made, tool = encoders.JsonEncoder(WORD), Tokenizer.from_file(WORD)
    expected = [tool.encode(t, add_special_tokens=False).ids for t in column]
    for _ in range(2):
        ids, ends = made.encode_column(pa.array(column))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == expected
    # even if all pieces had the same few hashes, the bytes would tell them apart
    real = encoders.words.range_hashes
    monkeypatch.setattr(encoders.words, "range_hashes", lambda *args, **options: real(*args, **options) % np.uint64(5))
    made, column = encoders.JsonEncoder(WORD), texts(5, 200)
    for _ in range(2):
        ids, ends = made.encode_column(pa.array(column))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [tool.encode(t or "", add_special_tokens=False).ids for t in column]


def test_a_tokenizer_that_joins_words_is_asked_piece_by_piece(monkeypatch):
    made, tool = encoders.JsonEncoder(WORD), Tokenizer.from_file(WORD)
    direct, column = made._direct, texts(6, 100)
    monkeypatch.setattr(made, "_direct", lambda found: direct([t[:-1] if len(found) == 1 and " " in t else t for t in found]))
    monkeypatch.setattr(made, "ends", np.zeros_like(made.ends))
    ids, ends = made.encode_column(pa.array(column))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [tool.encode(t or "", add_special_tokens=False).ids for t in column]


def test_piece_ids_equal_the_library():
    column = texts(2, 300)
    ids, ends = encoders.encoder(PIECE).encode_column(pa.array(column))
    expected = SentencePieceProcessor(model_file=PIECE).encode([t or "" for t in column])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == expected


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FRAME_IDS", 64)
    column = texts(3, 150)
    rows = [(i * 7 % 1009, t, "", "", 0) for i, t in enumerate(column)] + [(7, "again", "", "", 0), (7, "again", "", "", 0), (None, "no id", "", "", 0)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(5))
    written = tokenfiles.write_token_files(docs, Scratch(spark).path("tokens"), WORD)
    found = sorted((tuple(r) for r in tokenfiles.read_token_files(written, docs.schema["doc_id"].dataType).collect()), key=lambda r: r[1])
    tool = Tokenizer.from_file(WORD)
    made = {}
    for i, t, *_ in rows:
        made.setdefault(i, []).append(np.array([*tool.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    assert [r[0] for r in found] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i))
    total = 0
    for name, start, n, crc in found:
        assert start == total
        total += n
        left = made[name]
        place = next(k for k, ids in enumerate(left) if len(ids) == n and zlib.crc32(ids.tobytes()) == crc)
        left.pop(place)
    # single documents by the index
    one = written.filter("documents > 5").first()
    index = tokenfiles.read_index(one.file)
    picked = tokenfiles.read_documents(one.file, [0, 5, 3])
    assert [len(x) for x in picked] == [index["count"][k].as_py() for k in (0, 5, 3)]
    ids, ends = encoders.encoder(WORD).encode_column(pa.array([dict((r[0], r[1]) for r in rows)[index["id"][5].as_py()]]))
    if index["id"][5].as_py() != 7:
        assert picked[1].tolist() == [*ids.tolist(), 1]


def test_damaged_frame_is_refused(tmp_path):
    path = f"file:{tmp_path}/x.zst"
    writer = files.FrameWriter(path)
    for k in range(3):
        writer.frame(bytes([k]) * 1000)
    writer.close(b"index")
    with files.FrameReader(path) as reader:
        assert reader.frame(1) == b"\x01" * 1000 and reader.index() == b"index"
        start = int(reader.starts[2])
    data = bytearray((tmp_path / "x.zst").read_bytes())
    data[start + 10] ^= 255
    (tmp_path / "x.zst").write_bytes(data)
    with files.FrameReader(path) as reader:
        assert reader.frame(0) == b"\x00" * 1000
        with pytest.raises(Exception):
            reader.frame(2)
    (tmp_path / "y.zst").write_bytes(b"not a file of frames")
    with pytest.raises(ValueError):
        files.FrameReader(f"{tmp_path}/y.zst")


def test_no_documents(spark):
    assert tokenfiles.token_table(nothing(spark, DOCS), WORD).collect() == []
    cache = Scratch(spark).path("cache")
    assert token_counts.count_tokens(nothing(spark, DOCS), cache, PIECE).collect() == []


def test_digest_cache_encodes_only_misses(spark):
    column = texts(5, 40)
    rows = [(i, t, "", "", 0) for i, t in enumerate(column)] + [(3, column[3], "", "", 0), (None, "no id", "", "", 0)]
    docs, cache = with_clashes(spark.createDataFrame(rows, DOCS)), Scratch(spark).path("cache")
    tool = SentencePieceProcessor(model_file=PIECE)
    expected = sorted(((r[0], len((r[1] or "").encode()), len(tool.encode(r[1] or "")), len(tool.encode(r[1] or "")) > 50) for r in rows), key=str)
    for _ in range(2):
        found = token_counts.count_tokens(docs, cache, PIECE, limit=50).collect()
        assert sorted(map(tuple, found), key=str) == expected
        assert spark.read.parquet(cache).count() == len({t or "" for _, t, *_ in rows})
    # a stored count is used as it stands, and another tokenizer has counts of its own
    more = spark.createDataFrame([(1, "marked text", "", "", 0)], DOCS)
    import hashlib

    stored = [(token_counts.file_digest(PIECE), bytearray(hashlib.sha256(b"marked text").digest()), 12345)]
    spark.createDataFrame(stored, token_counts.CACHE).write.mode("append").parquet(cache)
    assert token_counts.count_tokens(more, cache, PIECE).first().n_tokens == 12345
    assert token_counts.count_tokens(more, cache, WORD).first().n_tokens == len(Tokenizer.from_file(WORD).encode("marked text", add_special_tokens=False).ids)


def test_copies_meet_a_filled_cache_once(spark):
    """A third of all rows has one text: it is encoded and stored once, and a second run encodes only what is new."""
    cache = Scratch(spark).path("cache")
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 50}", "", "", 0) for i in range(600)]
    first = token_counts.count_tokens(spark.createDataFrame(rows, DOCS).repartition(4), cache, PIECE)
    assert first.count() == 600 and token_counts.read_cache(spark, cache).count() == 51
    more = rows + [(1000 + i, f"new {i}", "", "", 0) for i in range(5)]
    frame = spark.createDataFrame(more, DOCS)
    second = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame, cache, PIECE).collect()}
    assert token_counts.read_cache(spark, cache).count() == 56
    tool = SentencePieceProcessor(model_file=PIECE)
    assert second == {r[0]: len(tool.encode(r[1])) for r in more}


def test_a_cut_hands_workers_bounded_batches(spark, tmp_path):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    docs = spark.range(0, 6000, 1, 1).selectExpr("id", "repeat('word ', 1000) AS text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = Scratch(spark, str(tmp_path)).cut(docs.mapInArrow(measure, "rows long, bytes long"), "batches").collect()
    assert sum(r["rows"] for r in found) == 6000
    assert max(r["bytes"] for r in found) < 10 << 20  # all 30 MB came as one
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_the_index_of_a_file_does_not_hold_the_texts():
    """Ids are copied out of a batch: what a file keeps until its end does not grow with the texts."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["word " * 20_000] * 50)], ["id", "text"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    read = next(iter(pa.ipc.open_stream(sink.getvalue().to_pybytes())))
    before = pa.total_allocated_bytes()
    ids = tokenfiles.copied(read.column(0))
    assert ids.equals(batch.column(0)) and ids.buffers()[1].address != read.column(0).buffers()[1].address
    assert pa.total_allocated_bytes() - before < 1 << 16
