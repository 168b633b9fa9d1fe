import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import ogg, queue_bpe, ragged_bpe
from corpusmill.llm.tokenizer_files import parse

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
EDGES = ["", " ", "\n\n", "a", "aaaaaaaaa", "it's 12345  x\t\ty", "<|endoftext|>", "a<|startoftext|>b<|endoftext|>", "ÉCOLE ΣΑΣ café naïve", "日本語 テキスト 한국어", "🙂🙂 !!!???", "x" * 5000, "a b" * 3000, "\x00\x01", "don't WE'LL"]


def texts():
    random.seed(5)
    bits = ["the", "ing ", " ", "\n", "'s", "42", "é", "ß", "Ж", "漢", "!", "..", "aa", "<|endoftext|>", "_", "\u00a0", "Tion"]
    return EDGES + ["".join(random.choice(bits) for _ in range(random.randrange(1, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts())] + [(None, None, "clash", 7), (3, "a", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int")


def test_counts_like_the_library(frame):
    library = Tokenizer.from_file(BYTE)
    for r in ragged_bpe.count_tokens(frame, BYTE, 10).join(frame.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
        assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids), r.text
        assert r.n_bytes == len(r.text.encode()) and r.over_limit == (r.n_tokens > 10)
    assert ragged_bpe.count_tokens(frame, BYTE).count() == frame.count()
    assert ragged_bpe.count_tokens(frame.where("doc_id is null"), BYTE).collect() == [(None, 0, 0, False)]
    assert ragged_bpe.count_tokens(frame.where("false"), BYTE).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(ragged_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(queue_bpe, "REMEMBERED", 3)
    counter, codec = (kind(parse(open(p, encoding="utf-8").read())) for kind, p in ((ragged_bpe.RaggedCounter, BYTE), (queue_bpe.QueueCodec, WORD)))
    a, b = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    for t in texts()[:150]:
        assert counter.counts([t, "again " + t]) == [len(a.encode(x, add_special_tokens=False).ids) for x in (t, "again " + t)]
        assert codec.encode(t) == b.encode(t, add_special_tokens=False).ids


def test_encoding_and_decoding_like_the_library(frame):
    library = Tokenizer.from_file(WORD)
    ids = {r.doc_id: r.ids for r in queue_bpe.encode_texts(frame, WORD).collect() if r.doc_id not in (None, 3)}
    decoded = {r.doc_id: r.decoded for r in queue_bpe.decode_ids(queue_bpe.encode_texts(frame, WORD), WORD).collect()}
    digests = {r.doc_id: r for r in queue_bpe.round_trip(frame, WORD).collect()}
    for i, t in enumerate(texts()):
        if i == 3:
            continue
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[i] == want and decoded[i] == library.decode(want, skip_special_tokens=False)
        assert digests[i].n_tokens == len(want)
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded[i].encode()).hexdigest()
    assert digests[None].n_tokens == 0 and queue_bpe.round_trip(frame.where("false"), WORD).count() == 0


def test_stored_media_reads_back(frame):
    stored = ogg.store(frame)
    rows = {r.doc_id: r for r in ogg.read(stored).collect()}
    media = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for i, t in [*enumerate(texts()), (None, "")]:
        if i == 3:
            continue
        raw = t.encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media[i]), hashlib.sha256(media[i]).hexdigest())
        assert f"seconds={len(payload) / ogg.RATE:.6f}" in r.feature and "damaged=0" in r.feature
    assert ogg.read(stored.where("false")).count() == 0
    alien = ogg.read(stored.select("doc_id", F.lit(b"OggS and nothing more").alias("media")).limit(1)).first()
    assert (alien.payload_bytes, alien.n_bytes) == (0, 0)


def bitwise_checksum(data):
    state = 0
    for byte in data:
        state ^= byte << 24
        for _ in range(8):
            state = (state << 1 ^ 0x04C11DB7 if state >> 31 else state << 1) & 0xFFFFFFFF
    return state


def test_checksum_bit_by_bit():
    random.seed(1)
    for n in (0, 1, 27, 300):
        data = random.randbytes(n)
        assert ogg.page_checksum(data) == bitwise_checksum(data)


@pytest.mark.parametrize("sizes", [[10, 0, 255, 510, 600, 1], [10, 100_000, 3], [255 * 255, 255 * 254, 7], [5], [0, 70_000]])
def test_packets_over_pages(sizes):
    random.seed(2)
    data = [random.randbytes(n) for n in sizes]
    ends = [0] + [sum(sizes[1 : k + 1]) for k in range(1, len(sizes))]
    pages = ogg.stream_pages(9, data, ends)
    streams, sound, damaged = ogg.demultiplex(b"".join(pages))
    assert streams[9].packets == data and (sound, damaged) == (len(pages), 0)
    assert streams[9].ends[1:] == ends[1:] and streams[9].starts[1:] == ([0, *ends[1:-1]] if len(sizes) > 1 else [])


def test_damage_is_found_and_streams_are_told_apart(spark):
    payload = random.randbytes(576 * 300)
    whole = ogg.write(payload, 5)
    streams, sound, _ = ogg.demultiplex(whole)
    assert b"".join(streams[ogg.SAMPLES].packets[2:]) == payload and struct.unpack("<Q", streams[ogg.INFO].packets[1])[0] == 5
    broken = bytearray(whole)
    broken[60_000] ^= 1
    streams, left, damaged = ogg.demultiplex(bytes(broken))
    assert (left, damaged) == (sound - 1, 1) and len(streams[ogg.SAMPLES].packets) == 2 + 300 - 86  # packets that reach into the page
    cut, _, damaged = ogg.demultiplex(whole[:-10])
    assert damaged == 1 and len(cut[ogg.SAMPLES].packets) < 302
    rows = ogg.packets(spark.createDataFrame([(1, whole), (2, None)], "doc_id int, media binary"))
    assert rows.count() == 304 and rows.where("serial = 1").agg(F.max("end_sec")).first()[0] == pytest.approx(len(payload) / ogg.RATE)


def test_every_code_point_like_the_library():
    library, codec = Tokenizer.from_file(WORD), queue_bpe.QueueCodec(parse(open(WORD, encoding="utf-8").read()))
    points = [chr(c) for c in range(0x80, 0x32400) if not 0xD800 <= c < 0xE000]
    wanted = library.encode_batch([f"a{c}b" for c in points], add_special_tokens=False)
    assert [c for c, w in zip(points, wanted) if codec.encode(f"a{c}b") != w.ids] == []


def test_a_stream_of_another_kind_tells_no_length(spark):
    pages = ogg.stream_pages(ogg.SAMPLES, [b"head", b"comment", b"x" * 576], [0, 0, 576]) + ogg.stream_pages(ogg.INFO, [b"length", b"three"], [0, 5])
    row = ogg.read(spark.createDataFrame([(1, b"".join(pages))], "doc_id long, media binary")).first()
    assert (row.n_bytes, row.payload_bytes) == (576, 576)
