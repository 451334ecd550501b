"""Token files and lexicon BPE against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ipscope.llm import bpe_lexicon, catalog, pieces, token_files
from ipscope.llm.common import table
from ipscope.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(catalog.BYTE_BPE)


@pytest.fixture(scope="module")
def lexicon_encoder(tmp_path_factory):
    merges = bpe_lexicon.Merges.at(catalog.BYTE_BPE)
    words = [" the", " then", " thence", "a", " a", "\n", "!!", " hello", " é"]
    path = tmp_path_factory.mktemp("lex") / "words.bin"
    path.write_bytes(bpe_lexicon.compile_lexicon({w.encode(): i for w, i in zip(words, merges.merge(words))}))
    encoder = bpe_lexicon.LexiconEncoder.__new__(bpe_lexicon.LexiconEncoder)
    encoder.merges, encoder.lexicon = merges, bpe_lexicon.Lexicon(str(path))
    encoder.column = pieces.ColumnEncoder(encoder.words, "<i4", list(merges.special), 1000)
    return encoder


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def check(texts, tokenizer, lexicon_encoder):
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert split(*lexicon_encoder.column(pa.array(texts))) == want
    found = token_files.PieceEncoder.at(catalog.BYTE_BPE).encode(pa.array(texts), 2)
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [w + [2] for w in want]
    ids = np.array([i for w in want for i in w], np.int64)
    decoded = lexicon_encoder.merges.decode(ids, np.array([len(w) for w in want]))
    assert decoded == [tokenizer.decode(w, skip_special_tokens=False) for w in want]


def test_all_letters_between_letters_and_spaces(tokenizer, lexicon_encoder):
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + list(range(0xFE00, 0x10000)) + list(range(0x1F300, 0x1F400))
    texts = ["".join(f"a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}! {chr(c)}x  {chr(c)}7 " for c in points[i:i + 50])
             for i in range(0, len(points), 50)]
    check(texts, tokenizer, lexicon_encoder)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab the.,'s\n\t é12<|endoftext|>字  \x1c\x85")), max_size=60), min_size=1, max_size=5))
def test_random_texts(tokenizer, lexicon_encoder, texts):
    check(texts, tokenizer, lexicon_encoder)


def test_special_tokens_and_long_words(tokenizer, lexicon_encoder):
    check(["<|endoftext|>", "x <|endoftext|> y<|endoftext|><|endoftext|>", "<|endo" + "ftext|", "a" * 3000, "", " ", "ab" * 500 + "é" * 99],
          tokenizer, lexicon_encoder)


def test_automaton_shares_suffixes_and_knows_its_words():
    words = sorted({(a + b + "ing").encode() for a in ("sort", "find", "read", "writ") for b in ("", "er", "est")})
    blob = bpe_lexicon.compile_lexicon({w: [i, i + 1] for i, w in enumerate(words)})
    lexicon = bpe_lexicon.Lexicon.__new__(bpe_lexicon.Lexicon)
    sizes = np.frombuffer(blob, np.int64, 6)
    parts, at = [], 48
    for n in sizes:
        parts.append(np.frombuffer(blob, np.int64, n, at))
        at += 8 * n
    lexicon.keys, lexicon.next, lexicon.add, lexicon.final, lexicon.offsets, lexicon.ids = parts
    assert len(lexicon.final) < sum(map(len, words)) / 3
    places = lexicon.places([*words, b"", b"sor", b"sorting!", b"xing"])
    assert places.tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert [lexicon.ids[lexicon.offsets[p]:lexicon.offsets[p + 1]].tolist() for p in places[:3]] == [[0, 1], [1, 2], [2, 3]]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_numbers_round_trip(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 1 << 32, n, dtype=np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
    control, data = token_files.pack(x)
    assert len(control) == -(-n // 4) and len(data) == sum(max(1, -(-int(v).bit_length() // 8)) for v in x)
    assert (token_files.unpack(control, data, n) == x).all()


def wanted(docs, tokenizer):
    four, ten, start = [], [], 0
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        ten.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        four.append((i, start, len(ids) + 1, zlib.crc32(np.array(ids + [2], "<u4").tobytes())))
        start += len(ids) + 1
    return four, ten


def test_queries_equal_the_library(spark, tokenizer):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    four, ten = wanted(docs, tokenizer)
    assert sorted(tuple(r) for r in catalog.op4_token_files(spark, SF).collect()) == four
    assert sorted(tuple(r) for r in catalog.op10_bpe_lexicon(spark, SF).collect()) == ten


def test_odd_rows(spark, tokenizer):
    key = lambda x: tuple((v is not None, v) for v in x)
    docs = sorted(((r[0], r[1]) for r in rows()), key=lambda x: (x[0] is not None, x[0], len(tokenizer.encode(x[1] or "").ids)))
    four, ten = wanted(docs, tokenizer)
    path = scratch_path(spark, "test")
    token_files.write_token_files(documents(spark), path, catalog.BYTE_BPE, block=64)
    got = [(r.doc_id, len(r.ids) // 4, zlib.crc32(bytes(r.ids))) for r in token_files.read_token_files(spark, path).collect()]
    assert sorted(got, key=key) == sorted(((i, n, c) for i, _, n, c in four), key=key)
    starts = sorted((r.start, len(r.ids) // 4) for r in token_files.read_token_files(spark, path).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    frame = documents(spark)
    lexicon = bpe_lexicon.build_lexicon(frame, catalog.BYTE_BPE, share=0.01)
    found = bpe_lexicon.digests(bpe_lexicon.decode(bpe_lexicon.encode(frame, catalog.BYTE_BPE, lexicon), catalog.BYTE_BPE))
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(ten, key=key)


def test_empty_tables(spark):
    path = scratch_path(spark, "test")
    token_files.write_token_files(empty(spark), path, catalog.BYTE_BPE)
    assert token_files.read_token_files(spark, path).collect() == []
    lexicon = bpe_lexicon.build_lexicon(empty(spark), catalog.BYTE_BPE)
    assert bpe_lexicon.decode(bpe_lexicon.encode(empty(spark), catalog.BYTE_BPE, lexicon), catalog.BYTE_BPE).collect() == []
