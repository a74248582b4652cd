"""Token operators against the tokenizer libraries, one text at a time."""

from __future__ import annotations

import base64
import hashlib
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from keyfold.llm import byte_bpe, packing, token_counts, token_files
from keyfold.llm.queries import RANKS, WORDS
from keyfold.llm.store import new_folder
from keyfold.llm.tokens import ByteTokens, WordTokens

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(WORDS)
    return found


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_ids(tokenizer, text, end):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aAbé ß'.,!?12\n\t\x1c\x85\xa0日İΣ́<|>क़ড়שׁ"), max_size=60))
def test_words_match_the_library(text):
    tokenizer = Tokenizer.from_file(WORDS) if not hasattr(test_words_match_the_library, "t") else (
        test_words_match_the_library.t
    )
    test_words_match_the_library.t = tokenizer
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert WordTokens.shared(WORDS).ids([text]) == [np.array(ids, "<u4").tobytes()]


def test_long_words_and_full_tables(tokenizer, monkeypatch):
    monkeypatch.setattr("keyfold.llm.tokens.TABLE_BYTES", 900)
    words = WordTokens(WORDS)
    texts = ["x" * 200 + ", " + "x" * 200, "some words, some more. Words", None, "", "a b c d e f g h"]
    expected = [word_ids(tokenizer, t, 0)[:-1].tobytes() for t in texts]
    assert words.ids(texts) == expected
    assert words.ids(texts, block=1) == expected


def test_words_of_a_block_are_looked_at_once_each(tokenizer):
    some = ["Some", "words", "words,", "wörds.", "WORDS!?", "12,", "don't.", "...", "x" * 60 + "."]
    text = " ".join(some * 40_000)
    expected = word_ids(tokenizer, " ".join(some), 0)[:-1].tobytes() * 40_000
    words = WordTokens(WORDS)
    words.ids([" ".join(some)])
    tracemalloc.start()
    found = words.ids([text])
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [expected]
    # beside the text and its ids no object for every word
    assert most < len(text) + len(expected) + 20 * len(some) * 40_000


def test_many_words_are_encoded_in_bounded_calls(tokenizer):
    class Counted:
        sizes = []

        def encode_batch_fast(self, words, **options):
            self.sizes.append(len(words))
            return tokenizer.encode_batch_fast(words, **options)

    text = " ".join(map(str, range(10_000)))
    words = WordTokens(WORDS)
    words._tokenizer = Counted()
    assert words.ids([text]) == [word_ids(tokenizer, text, 0)[:-1].tobytes()]
    assert sum(Counted.sizes) == 10_000 and max(Counted.sizes) <= 4096


def test_columns_in_blocks(tokenizer):
    texts = [None, "", " \t", "Words, words.\nWORDS", "a\x1cb c\x85d. e\xa0f,", "É é, Éa!", None, "x" * 50 + ":"]
    expected = [word_ids(tokenizer, t, 0)[:-1].tobytes() for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["before", *texts], kind).slice(1)
        for block in (1, 7, 25, 1 << 22):
            assert WordTokens(WORDS).ids(column, block) == expected
        assert WordTokens(WORDS).ids(column.slice(0, 3)) == expected[:3]
        assert WordTokens(WORDS).ids(column.slice(0, 0)) == []


def test_letters_that_gain_marks_and_special_tokens(tokenizer):
    letters = (chr(c) for c in range(0x80, 0x30000) if chr(c).isalpha())
    marked = [c for c in letters if not tokenizer.normalizer.normalize_str(c).isalpha()]
    assert len(marked) > 50
    texts = [f"{c}{tail} ab{c}{tail}{c}" for c in marked for tail in ("", ",", "!?")]
    texts += ["a<|endoftext|>b, <|endoftext|>. <|ENDOFTEXT|>", "<|startoftext|>"]
    assert WordTokens(WORDS).ids(texts) == [word_ids(tokenizer, t, 0)[:-1].tobytes() for t in texts]


def test_very_long_runs_of_white_space(encoding):
    encoder = ByteTokens.shared(RANKS, PATTERN)
    text = "x" + " " * 2_000_000 + "y\n" + "\u3000\n" * 700_000
    assert encoder.decode(encoder.ids(text)) == text.encode()
    for text in (f"a{' ' * 70_000}b", f"{' ' * 70_000}", f"я{chr(10) * 70_000}!{' ' * 70_000}"):
        assert encoder.ids(text) == encoding.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aAé 's\n\t1.?日\xa0"), max_size=80), st.integers(1, 12))
def test_safe_cuts_do_not_change_ids(text, most):
    encoder = ByteTokens.shared(RANKS, PATTERN)
    pieces = encoder.pieces(text, most)
    assert "".join(pieces) == text
    assert [i for p in pieces for i in encoder.ids(p)] == encoder.ids(text)


def test_byte_bpe(odd, none, odd_rows, encoding):
    found = Counter(map(tuple, byte_bpe.digests(odd, RANKS, PATTERN).collect()))
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = encoding.encode_ordinary(text or "")
        expected[
            doc_id,
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ] += 1
    assert found == expected
    back = byte_bpe.decode(byte_bpe.encode(odd, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert Counter(bytes(r.data) for r in back) == Counter((r[1] or "").encode() for r in odd_rows)
    assert byte_bpe.digests(none, RANKS, PATTERN).count() == 0


def test_token_counts(odd, none, odd_rows, encoding):
    sizes = [len(encoding.encode_ordinary(r[1] or "")) for r in odd_rows]
    hist = token_counts.histogram(token_counts.lengths(odd, RANKS, PATTERN))
    sums = token_counts.suffix_sums(hist)
    count = Counter(sizes)
    assert {r.n_tokens: r.n_docs for r in sums.collect()} == count
    for r in sums.collect():
        assert r.docs_from == sum(s >= r.n_tokens for s in sizes)
        assert r.tokens_from == sum(s for s in sizes if s >= r.n_tokens)
        assert r.docs_to == sum(s <= r.n_tokens for s in sizes)
        assert r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes)
    limits = [0, 1, 5, 50, 1000, 2000, 10**7]
    for r in token_counts.at_limits(sums, limits).collect():
        assert r.docs_over == sum(s > r.context for s in sizes)
        assert r.truncated_tokens == sum(min(s, r.context) for s in sizes)
    middle = sorted(sizes)[-(-len(sizes) // 2) - 1]
    assert token_counts.quantile(sums, 0.5).first()[0] == middle
    assert token_counts.suffix_sums(
        token_counts.histogram(token_counts.lengths(none, RANKS, PATTERN))
    ).count() == 0


@given(st.integers(0, 20_000), st.sampled_from([1, 2, 7, 64, 4096]))
def test_cuts_are_reciprocal_classes(tokens, capacity):
    found = packing.cuts(tokens, capacity)
    assert sum(found) == tokens
    classes = {capacity // k for k in range(1, capacity + 1)}
    assert set(found) <= classes


def check_packing(rows, texts, tokenizer, capacity):
    """Every id in one piece, sequences gapless, digests right."""
    ids = {d: word_ids(tokenizer, t, 2) for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in [*pieces.values(), *sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
    assert {d: sum(n for _, n in spans) for d, spans in pieces.items()} == {
        d: len(i) for d, i in ids.items()
    }
    assert all(sum(n for _, n in spans) <= capacity for spans in sequences.values())
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


def test_packing(spark, odd_rows, none, tokenizer):
    texts = {k: r[1] for k, r in enumerate(odd_rows)} | {k: f"some words {k} " * k for k in range(50, 350)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for capacity in (4096, 64):
        rows = packing.pack_documents(docs, WORDS, 2, capacity).collect()
        sequences = check_packing(rows, texts, tokenizer, capacity)
        total = sum(r.length for r in rows)
        assert len(sequences) <= -(-total // capacity) + 1 + total // capacity // 20
    assert packing.pack_documents(none, WORDS).count() == 0


def test_packing_of_null_and_repeated_ids(odd, odd_rows, tokenizer):
    rows = packing.pack_documents(odd, WORDS).collect()
    sizes = Counter()
    for doc_id, text, *_ in odd_rows:
        sizes[doc_id] += len(word_ids(tokenizer, text, 2))
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
    assert found == sizes
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_first_fit_places_all():
    rows = pd.DataFrame(
        {"doc_id": range(40), "start": 0, "length": [7, 5, 3, 1] * 10, "ids_crc32": 0,
         "doc_tokens": 1, "_first": 4}
    )
    placed = packing._first_fit(16)(rows)
    assert placed.groupby("sequence_id")["length"].sum().le(16).all()
    assert placed["sequence_id"].min() == 4 and len(placed) == 40


def test_token_files(spark, odd, none, odd_rows, tokenizer):
    folder = new_folder(spark, "test-files")
    manifest = token_files.write_tokens(odd, folder, WORDS, end_id=1).collect()
    assert sum(r.n_docs for r in manifest) == len(odd_rows)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = [], 0
    for doc_id, text, *_ in order:
        ids = word_ids(tokenizer, text, 1)
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = sorted(map(tuple, token_files.read_digests(spark, folder).collect()), key=lambda r: r[1])
    assert found == expected
    some = token_files.read_tokens(spark, folder, [7, 11, 99]).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in some) == [
        r[:3] for r in expected if r[0] in (7, 11)
    ]
    assert token_files.read_tokens(spark, folder, []).count() == 0
    assert token_files.read_tokens(spark, folder).count() == len(odd_rows)
    empty = new_folder(spark, "test-files")
    token_files.write_tokens(none, empty, WORDS)
    assert token_files.read_digests(spark, empty).count() == 0


def test_frames_are_independent_and_checked(tmp_path):
    path = str(tmp_path / "one.zst")
    store = fs.LocalFileSystem()
    ids = {5: np.arange(200_000, dtype="<u4") % 60_000, None: np.array([3], "<u4"), 9: np.zeros(0, "<u4")}
    with store.open_output_stream(path, compression=None) as sink:
        writer = token_files.FrameWriter(sink, wide=False)
        for doc_id, values in ids.items():
            writer.add(doc_id, values)
        writer.close()
    with store.open_input_file(path) as source:
        reader = token_files.FrameReader(source)
        assert [None if z else int(d) for d, z in zip(reader.doc_ids, reader.null)] == list(ids)
        for k, values in enumerate(ids.values()):
            assert (reader.ids(k) == values).all()
    with open(path, "r+b") as file:
        data = bytearray(file.read())
        data[60] ^= 1
        file.seek(0)
        file.write(data)
    with store.open_input_file(path) as source:
        reader = token_files.FrameReader(source)
        with pytest.raises(Exception):
            reader.ids(0)
        assert (reader.ids(1) == ids[None]).all()
