"""Byte-level BPE, token counts and token files against the libraries."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from odd_tables import no_docs, odd_docs  # noqa: F401
from scholarspark.llm import bpe, chunk_ids, token_counts, token_files
from scholarspark.session import shared_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def machine():
    return bpe.Transducer(bpe.read_ranks(RANKS), max_states=3000)


def test_transducer_equals_merging(machine):
    rng = random.Random(5)
    for _ in range(1500):
        data = bytes(rng.choice(b"abcdeinrst the") for _ in range(rng.randint(1, 24)))
        ids = bpe.merge_bytes(machine.ranks, data)
        assert machine.encode(data) == struct.pack(f"<{len(ids)}I", *ids), data
    assert len(machine.states) <= 3000


def test_many_at_once_equals_merging(machine):
    """Batches through the numpy transitions, tables emptied on the way, long pieces and single bytes among them."""
    rng = random.Random(6)
    small = bpe.Transducer(machine.ranks, max_states=500)
    for _ in range(30):
        pieces = [bytes(rng.choice(b"abcdeinrst the\xc3\xa9\xff") for _ in range(rng.choice([1, 5, 12, 63, 64, 65, 300]))) for _ in range(40)]
        ids, counts = small.encode_many(pieces)
        want = [bpe.merge_bytes(machine.ranks, p) for p in pieces]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert small.encode_many([])[0].tolist() == []


def test_chunks_equal_whole_texts(monkeypatch):
    """Chunks kept, forgotten, cut out of long texts, of odd white space and separators: as the libraries encode the whole text."""
    rng = random.Random(2)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\u2003", "\xa0", "é", "漢", "😀", "'s", "'LL", "12",
             "!!", "?", "_", "<|endoftext|>", "x" * 70, "\u0301"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)] + ["", None, "z" * 3000 + " " + "ab " * 2000]
    monkeypatch.setattr(chunk_ids, "CHARS", 500)
    own = bpe.chunk_encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, tok = token_files.library_encoder(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
    own.chunks.most_strings = library.chunks.most_strings = 300
    want = expected_ids(texts)
    for encoder, ids_of in ((own, want.__getitem__), (library, lambda t: tok.encode(t or "", add_special_tokens=False).ids)):
        for first in range(0, len(texts), 100):
            ids, counts = encoder.encode(texts[first:first + 100])
            expected = [ids_of(t) for t in texts[first:first + 100]]
            assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_latin_pieces_are_matches_of_the_pattern(monkeypatch):
    """Texts cut at once in numpy: as the pattern cuts each; ids as the library's, tables emptied on the way; known pieces do not
    go to the model again."""
    assert token_files.BYTE_LEVEL == public_tokenizers.PATTERN
    rng = random.Random(4)
    letters = [*" \n\t'", "  ", " '", "''", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", "r", "v", "e", "l", "s", "x", "é", "ß", "7", "²", "\xa0",
               "!", "\x0b", "\r", "\x7f", "\x00", "_", "\xad", "the"]
    texts = ["".join(rng.choice(letters[:-1]) for _ in range(rng.randrange(14))) for _ in range(20_000)]
    findall = token_files.regex.compile(public_tokenizers.PATTERN).findall
    for some in (texts, [t for t in texts if t.isascii()], [""], ["", "", "a"], ["'"], ["a'r", "'", "'s", "'l", "l"]):
        pieces, ends = token_files.latin_pieces(token_files.END.join([*some, ""]))
        assert pieces.to_pylist() == [p for t in some for p in (*findall(t), token_files.END)]
        assert np.diff(np.append(-1, ends)).tolist() == [len(findall(t)) + 1 for t in some]
    path = public_tokenizers.path("byte_bpe_50k.json")
    mixed = texts[:3000] + ["漢 'll", "a\x1c b", "\x1f", "x\x85y", "<|endoftext|>", "é\u0301", None, "", "word " * 50] * 30
    rng.shuffle(mixed)
    monkeypatch.setattr(token_files, "CHARS", 700)
    library, tok = token_files.library_encoder(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
    library.pieces.most_strings = 500
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in mixed]
    ids, counts = library.encode(mixed)
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    asked = []
    model = library.pieces.encode_many
    library.pieces.encode_many = lambda pieces: asked.append(pieces) or model(pieces)
    library.pieces.clear()
    library.encode(["plain words.", "words, plain words"])
    library.encode(["more plain words."])
    assert sorted(sum(asked, [])) == sorted(["plain", " words", ".", "", "words", ",", " plain", "more"])


def test_lookahead_is_bounded(machine):
    data = b"antidisestablishmentarianism" * 40
    assert machine.encode(data, window=64) == machine.encode(data, window=10 ** 9)


def test_utf8_machine_never_cuts_characters():
    text = "aé漢😀" * 50
    m, out = bpe.Utf8Machine(), []
    for i in range(0, len(text.encode()), 3):
        out.append(m.feed(text.encode()[i:i + 3]))
    for piece in out:
        piece.decode("utf-8")
    assert b"".join(out) + m.close() == text.encode()


def expected_ids(text):
    ranks = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {t: enc.encode_ordinary(t or "") for t in text}


def test_encode_decode(odd_docs):
    ids = bpe.encode_documents(odd_docs, RANKS, public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "n_tokens", "ids"]
    rows = bpe.decode_documents(ids.withColumn("decoded", ids["n_tokens"]), RANKS, block=8).collect()
    once = bpe.encode_documents(odd_docs, RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted(map(tuple, once), key=repr) == sorted(map(tuple, rows), key=repr)
    texts = [r["text"] for r in odd_docs.collect()]
    want = expected_ids(texts)
    got = sorted((r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), r["decoded"]) for r in rows)
    assert got == sorted((len(want[t]), hashlib.sha256(struct.pack(f"<{len(want[t])}I", *want[t])).hexdigest(), t or "")
                         for t in texts)


def test_token_counts(odd_docs, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False).ids))
                   for r in odd_docs.collect()), key=repr)
    for head in (0, 3, 1000):
        got = token_counts.token_counts(odd_docs, path, head=head).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_token_files(spark, odd_docs, no_docs):
    path, out = public_tokenizers.path("byte_bpe_50k.json"), shared_path(spark, "test-tokens")
    token_files.write_tokens(odd_docs, out, path, public_tokenizers.PATTERN, num_partitions=4)
    tok = Tokenizer.from_file(path)
    rows = token_files.read_tokens(spark, out).orderBy("start").collect()
    order = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    assert len(rows) == len(order)
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in order]
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 0
        at += r["n_tokens"]
    want = sorted(tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids) + (0,) for r in order)
    assert sorted(tuple(r["ids"]) for r in rows) == want
    crc = {r["start"]: r["ids_crc32"] for r in token_files.ids_crc32(token_files.read_tokens(spark, out)).collect()}
    assert all(crc[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    plan = token_files.read_tokens(spark, out).where("doc_id = 5").select("doc_id", "n_tokens")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,5)" in text and "ids" not in text.split("ReadSchema")[1].split(">")[0]
    empty = shared_path(spark, "test-no-tokens")
    token_files.write_tokens(no_docs, empty, path, public_tokenizers.PATTERN, num_partitions=2)
    assert token_files.read_tokens(spark, empty).count() == 0
