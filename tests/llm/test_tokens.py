"""BPE by chunks and token files against the tokenizer itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from strandline.llm import bpe, queries, token_files
from strandline.llm.queries import tokenizer_path

from .conftest import texts

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\n\n\n", "\t", "a", "the", "é", "\u00a0", "\u3000", "'s", "'t", "'S", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "12", "!?", ".", ",", "ñ",
         "日本", "\u0301", "Σ", "ΑΣ", "\x1c", "\u2009", "\r\n", "İ", "x" * 300, "\u0085", "Word", "word", "\x00"]


@pytest.mark.parametrize(("path", "repair"), [(BYTE, True), (WORD, False)])
def test_any_text(path, repair):
    rng, chunks, whole = random.Random(5), bpe.Chunks(path, repair, 500), bpe._load(path)
    for _ in range(2500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        assert chunks.encode([text.encode()])[0].tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    assert not repair or chunks.repaired


def prose(seed, n=600):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) + rng.choice(["", "", "", ",", ".", "'s"]) for _ in range(n))


def test_joins_inside_words_are_encoded_anew():
    chunks, whole, texts_ = bpe.Chunks(BYTE), bpe._load(BYTE), [prose(i) for i in range(30)]
    got = chunks.encode([t.encode() for t in texts_])
    assert [g.tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts_]
    assert chunks.repaired
    # passages are of many words, and equal ones are met again behind other beginnings
    assert len(chunks.passages.known) * 50 < sum(len(t.split()) for t in texts_)
    met = set(chunks.passages.known)
    chunks.encode([("other " + t).encode() for t in texts_])
    assert len(set(chunks.passages.known) - met) <= len(texts_)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_short_passages(monkeypatch, bits):
    monkeypatch.setattr(bpe, "JOIN_BITS", bits)
    rng, chunks, whole = random.Random(7), bpe.Chunks(BYTE, True, 300), bpe._load(BYTE)
    for _ in range(150):
        texts_ = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(8)]
        assert [g.tolist() for g in chunks.encode([t.encode() for t in texts_])] == [whole.encode(t, add_special_tokens=False).ids for t in texts_]


@pytest.mark.parametrize("part", [slice(-40, None), slice(0, -40), slice(0, None)])
def test_a_window_is_widened_until_its_ids_agree(part):
    """Ids that spell the right bytes but are not the tokenizer's, in a part of a passage beside a join."""
    chunks, whole, text = bpe.Chunks(BYTE), bpe._load(BYTE), prose(3, 900)
    encode = lambda t: whole.encode(t, add_special_tokens=False).ids
    want = encode(text)
    assert chunks.encode([text.encode()])[0].tolist() == want
    raw, store = np.frombuffer(text.encode(), np.uint8), chunks.passages
    starts = chunks._borders(raw, np.array([0]))
    assert len(starts) > 3
    hashes, lengths = chunks._hashes(raw, starts)
    passage = text[starts[1] : starts[1] + lengths[1]]
    a, b, _ = part.indices(len(passage))
    ids = [*encode(passage[:a]), *(encode(c)[0] for c in passage[a:b]), *encode(passage[b:])]
    code = store.known[hashes[1]]
    store.flat = np.concatenate((store.flat[: store.used], np.array(ids, np.uint32)))
    store.starts[code], store.lengths[code], store.used = store.used, len(ids), store.used + len(ids)
    assert chunks.encode([text.encode()])[0].tolist() == want


def test_new_chunks_go_to_the_tokenizer_together():
    chunks, whole, given = bpe.Chunks(WORD, False), bpe._load(WORD), []

    class Counted:
        def encode_batch(self, texts_, **kw):
            given.extend(texts_)
            return whole.encode_batch(texts_, **kw)

        def encode_batch_fast(self, texts_, **kw):
            given.extend(texts_)
            return whole.encode_batch_fast(texts_, **kw)

    chunks.tokenizer = Counted()
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh\u0301\u00e9'", k=6)) for _ in range(3000)]
    # the last text holds the separator itself
    texts_ = [" ".join(words[:1500]), " ".join(words[1500:]), "a \x1f b\x1f c"]
    assert [i.tolist() for i in chunks.encode([t.encode() for t in texts_[:2]])] == [whole.encode(t, add_special_tokens=False).ids for t in texts_[:2]]
    assert len(given) <= -(-3000 // bpe.TOGETHER) + 1
    assert chunks.encode([texts_[2].encode()])[0].tolist() == whole.encode(texts_[2], add_special_tokens=False).ids


def test_decoding_is_the_tokenizers():
    pieces, whole, rng = bpe.Pieces(BYTE), Tokenizer.from_file(BYTE), random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 40))]
        assert pieces.decode(np.array(ids, np.int64)).decode("utf-8", "replace") == whole.decode(ids, skip_special_tokens=False)


def test_collisions_are_caught(spark, monkeypatch):
    monkeypatch.setattr(bpe.wordhash, "mix", lambda h: h & np.uint64(7))  # nearly all chunks collide
    texts_ = ["one two three four", "five six seven", ""]
    batches = iter([__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts_})])
    bpe._KEPT.clear()
    got = [r for b in bpe.encoder(BYTE)(batches) for r in b.column("ids").to_pylist()]
    bpe._KEPT.clear()
    whole = bpe._load(BYTE)
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts_]


def test_rows(docs, no_docs):
    whole = bpe._load(BYTE)
    encoded = docs.select("doc_id", "text").mapInArrow(bpe.encoder(BYTE), bpe.ENCODED)
    got = sorted(((r.doc_id, r.ids, r.text) for r in encoded.mapInArrow(bpe.decoder(BYTE), "doc_id long, ids array<int>, text string").collect()), key=str)
    want = [(i, whole.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in texts()]
    assert got == sorted(want, key=str)
    assert no_docs.select("doc_id", "text").mapInArrow(bpe.encoder(BYTE), bpe.ENCODED).count() == 0


@pytest.mark.parametrize("planes", [4, 32])
def test_planes(planes):
    ids = np.random.default_rng(1).integers(0, 2**32, 1003, dtype=np.uint32)
    assert token_files.ids_of(token_files.planes_of(ids, planes), len(ids)).tolist() == ids.tolist()
    assert token_files.ids_of(token_files.planes_of(ids[:0], planes), 0).tolist() == []


@pytest.mark.parametrize("planes", [4, 32])
def test_files(docs, no_docs, stage, tmp_path, monkeypatch, planes):
    monkeypatch.setattr(token_files, "BLOCK", 1 << 12)
    manifest = token_files.write(docs, stage, WORD, f"file://{tmp_path}/out", planes=planes, parts=4)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in token_files.read(manifest).collect())
    whole, at = bpe._load(WORD), 0
    want = {}
    for i, t, _ in texts():
        want.setdefault(i, []).append(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert [g[1] for g in got] == sorted((i for i, _, _ in texts()), key=lambda i: (i is not None, i))
    for start, doc_id, ids in got:
        assert start == at and ids in want[doc_id]
        want[doc_id].remove(ids)
        at += len(ids) // 4
    empty = token_files.write(no_docs, stage, WORD, f"file://{tmp_path}/none")
    assert empty.count() == 0 and token_files.read(empty).count() == 0


@pytest.mark.parametrize("bound", ["ids", "docs"])
def test_files_are_rolled(spark, stage, tmp_path, bound):
    """Files follow the bounds, not the parts, and together still hold all ids in order."""
    rows = [(i, f"word {i} " * (i % 9)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = token_files.write(docs, stage, WORD, f"file://{tmp_path}/out", parts=2, group=64, **{f"file_{bound}": 150 if bound == "ids" else 7})
    files = manifest.orderBy("part", "file").collect()
    assert len(files) > 8 and sum(f.n_docs for f in files) == 120 and len({f.path for f in files}) == len(files) == len(list((tmp_path / "out").iterdir()))
    assert [f.start for f in files] == [sum(g.n_ids for g in files[:k]) for k in range(len(files))]
    whole, at = bpe._load(WORD), 0
    for row, (i, text) in zip(sorted(token_files.read(manifest).collect(), key=lambda r: r.doc_id), rows):
        want = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert (row.doc_id, row.start, bytes(row.ids)) == (i, at, want)
        at += len(want) // 4


def test_digests_of_the_queries(spark, tmp_path):
    """Every column of the registered queries against the tokenizer itself."""
    rows = [(i, t) for i, (_, t, _) in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    byte, word, at, want5, want6 = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD), 0, [], []
    for i, text in rows:
        ids = byte.encode(text or "", add_special_tokens=False).ids
        back = byte.decode(ids, skip_special_tokens=False)
        want5.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        ids = [*word.encode(text or "", add_special_tokens=False).ids, 1]
        want6.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got5 = queries.op5_bpe_round_trip(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    got6 = queries.op6_token_files(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got5)) == want5 and sorted(map(tuple, got6)) == want6


def test_a_torn_file_is_refused(docs, stage, tmp_path):
    manifest = token_files.write(docs, stage, WORD, f"file://{tmp_path}/out", parts=1)
    path = manifest.first()["path"].removeprefix("file://")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-3])
    with pytest.raises(Exception, match="no complete token file"):
        token_files.read(manifest).collect()
