"""Byte-level BPE against the tokenizer library and against merging pair by pair."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from claimtide.llm import bytepair

ALPHABETS = ("abc", "etaoin shrdlu ", "aA1 !\n\t", "éüß日本語🎉a", "\x00\x1c\x1d\x85\xa0   ", "aaaa", "-=_*# ", "don't we'll ")


@pytest.fixture(scope="module")
def tokens():
    return bytepair.read_ranks(public_tokenizers.path(bytepair.VOCABULARY))


@pytest.fixture(scope="module")
def codec(tokens):
    return bytepair.Codec(tokens)


@pytest.fixture(scope="module")
def library(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: r for r, t in enumerate(tokens)})


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_random_texts(codec, library):
    draw = random.Random(5)
    for _ in range(4000):
        letters = draw.choice(ALPHABETS)
        text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 80)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_every_character_is_of_the_same_class(codec, library):
    for low in range(0, 0x110000, 0x400):
        letters = [chr(c) for c in range(low, low + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a {c}{c}b 1{c} {c}\n!{c}" for c in letters)
        if library.encode_ordinary(text) != codec.encode(text):
            assert [c for c in letters if codec.encode(f"a {c}b") != library.encode_ordinary(f"a {c}b")] == []


def test_neighbours_are_those_that_merging_keeps_apart(tokens, codec, library):
    draw = random.Random(6)
    for _ in range(20_000):
        a, b = draw.randrange(len(tokens)), draw.randrange(2000)
        assert codec.neighbours(a, b) == (library._encode_single_piece(tokens[a] + tokens[b]) == [a, b])


def test_step_back_where_the_longest_match_leads_nowhere():
    # Merges: a+b, c+d, bc is only reached before them; "abcd" must not begin with the longest match "abc".
    singles = [bytes([b]) for b in range(256)]
    small = bytepair.Codec([*singles, b"cd", b"ab", b"abc"], pattern=r".+")
    assert small.encode("abcd") == [257, 256] and small.encode("abce") == [258, ord("e")]


@pytest.mark.parametrize("text", ["x" * 300_000, "=-" * 100_000, " " * 200_000, "ab" * 100_000])
def test_long_matches_take_linear_time(codec, text):
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()


def test_documents_round_trip(spark, documents, library):
    encoded = bytepair.encode_documents(documents, packed=True)
    assert encoded.columns == [c for c in documents.columns if c != "text"] + ["ids"]
    got = {r.doc_id: (bytes(r.ids), bytes(r.bytes)) for r in bytepair.decode_documents(encoded).collect()}
    for r in documents.collect():
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (packed(ids), (r.text or "").encode())


def test_query_digests(spark, documents, library):
    from claimtide.llm import queries
    got = {r.doc_id: r for r in queries.QUERIES["op13_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for r in documents.collect():
        ids, row = library.encode_ordinary(r.text or ""), got[r.doc_id]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_ugly_texts(ugly, clashing, nothing, library):
    want = sorted((r.doc_id is None, r.doc_id or 0, library.encode_ordinary(r.text or "")) for r in ugly.collect())
    for docs in (ugly, clashing):
        rows = bytepair.decode_documents(bytepair.encode_documents(docs)).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in rows) == want
    assert bytepair.encode_documents(nothing).collect() == []


def test_bad_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bytepair.Codec([b"a", b"b"])


def test_batches_are_worked_on_in_slices():
    """A worker holds the results of few rows at a time; the rows stay whole and in order."""
    batch = pa.RecordBatch.from_pydict({"text": [str(i) for i in range(1201)]})
    parts = list(bytepair.in_slices(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert max(p.num_rows for p in parts) <= bytepair.ROWS
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist() + ["0", "1", "2"]
