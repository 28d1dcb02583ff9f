"""Token counts, packing, secret scans and the automaton against brute force."""

import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import TEXTS, base_secrets, documents, rows_of, sha
from tokenizers import Tokenizer

from tessera.llm import packing, pretokens, secret_scan, token_counts
from tessera.llm.automaton import compile_rules
from tessera.llm.shared import kgrams, ship_package

JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def test_counts_equal_the_library(spark):
    got = rows_of(token_counts.count_tokens(documents(spark), JSON))
    exp = [(d, len((t or "").encode()), len(ids(t)), len(ids(t)) > 1024) for d, t in TEXTS]
    assert got == sorted(exp, key=str)
    assert token_counts.count_tokens(documents(spark, []), JSON).count() == 0


def test_counts_of_other_tokenizers(spark):
    import sentencepiece

    some = [r for r in TEXTS if r[1] and len(r[1]) < 1000]
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows_of(token_counts.count_tokens(documents(spark, some), public_tokenizers.path("word_bpe_49k.json")), "doc_id", "n_tokens")
    assert got == sorted([(d, len(word.encode(t, add_special_tokens=False).ids)) for d, t in some], key=str)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(token_counts.count_tokens(documents(spark, some), public_tokenizers.path("piece_bpe_32k.model")), "doc_id", "n_tokens")
    assert got == sorted([(d, len(sp.encode(t))) for d, t in some], key=str)


def test_split_agrees_with_the_library_on_every_undisputed_code_point():
    pre = LIBRARY.pre_tokenizer
    for c in range(0x110000):
        if unicodedata.category(chr(c)) in ("Cs", "Co") or pretokens.DISPUTED.match(chr(c)):
            continue
        s = f"a{chr(c)}1{chr(c)}!{chr(c)}a"
        assert pretokens.split_pretokens(s) == [s[a:b] for _, (a, b) in pre.pre_tokenize_str(s)], hex(c)


def test_ids_of_random_texts():
    bpe = pretokens.ByteBpe(pretokens.tokenizer_spec(JSON))
    parts = [" ", "  ", "\n", "\t", "a", "It's", "é", "ß1", "1234", "!?", "<|endoftext|>", "\x1c", "\x85", "\xa0", "x" * 80, "日本", "'s", "²"]
    r = random.Random(3)
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(bpe.ids(t), "<u4").tolist() == ids(t), repr(t)
        assert bpe.count(t) == len(ids(t)), repr(t)


@pytest.mark.parametrize("entries", [0, 1, 64])
def test_lookup_stays_small_and_keeps_frequent_pretokens(entries):
    bpe = pretokens.ByteBpe(pretokens.tokenizer_spec(JSON), cache_entries=entries)
    pieces, encoded = bpe.pieces, []
    pieces.encode = lambda p: encoded.append(p) or bpe._encode(p)
    for k in range(20):
        text = " ".join(f"the {'q' * (i % 7)}x{k}y{i} of été 日" for i in range(40)) + (" 1" + "z" * 100) * 5
        assert np.frombuffer(bpe.ids(text), "<u4").tolist() == ids(text)
        assert len(pieces) + len(pieces.old) <= entries and not pieces.long
        assert encoded.count("z" * 100) == k + 1
    assert entries < 64 or all(encoded.count(p) == 1 for p in (" the", " of", " été", " 日"))


@pytest.mark.parametrize("n", [0, 1, 2, 40, 300])
def test_differencing_packs_every_token_once(n):
    r = np.random.default_rng(n)
    sizes = r.integers(1, 1024, n).tolist()
    for cut in (True, False):
        windows = packing.pack_sizes(sizes, 1024, cut)
        pieces = sorted(p for w in windows for p in w)
        for i, size in enumerate(sizes):
            at = 0
            for _, start, length in (p for p in pieces if p[0] == i):
                assert start == at
                at += length
            assert at == size
        assert all(0 < sum(p[2] for p in w) <= 1024 for w in windows)
        assert not cut or len(windows) <= -(-sum(sizes) // 1024) + 1
    near = packing.karmarkar_karp(np.array(sizes, "int64"), 7)
    assert sorted(i for w in near for i in w) == list(range(n))


def test_packing_round_trip(spark):
    got = packing.pack(documents(spark), JSON, with_ids=True).collect()
    per = {}
    for d, t in TEXTS:
        per.setdefault(d, []).append(ids(t) + [0])
    fill = {}
    for r in got:
        assert r.length * 4 == len(r.ids) and zlib.crc32(r.ids) == r.ids_crc32
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert any(own == x[r.start : r.start + r.length] and len(x) == r.doc_tokens for x in per[r.doc_id])
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) for xs in per.values() for x in xs)
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(documents(spark, []), JSON).count() == 0


def test_secret_spans_equal_regular_expressions():
    sc = secret_scan.Scanner()
    parts = ["token", "=", ":", " ", '"', "'", "secret", "api_key", "APIKEY", "PassWord", "passwd", "abcdef", "0123456789abcdef", "AKIA",
             "ABCD1234EFGH5678", "é", "K", "ſ", "x", "-", "/", "eyJ", ".", "gh", "p_", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "\n", "tok", "0a"]
    r = random.Random(1)
    for _ in range(15_000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 24)))
        got = sc.spans(t)
        assert [x for x in got if x[0] < 3] == base_secrets(t), t
        for k in range(3, len(secret_scan.RULES)):
            rule = secret_scan.RULES[k]
            assert [x[1:] for x in got if x[0] == k] == [m.span() for m in re.finditer(rule.pattern, t) if m.end() - m.start() >= rule.least]


def test_automaton_matches_like_the_regex():
    for pattern in ("ab*c", "(a|bc)+d?", "[^a]{2,4}", "x(yz)?x"):
        dfa = compile_rules([(pattern, False)], search=False)
        r = random.Random(5)
        for _ in range(500):
            s = "".join(r.choice("abcdxyz") for _ in range(r.randint(0, 8)))
            best = max((n for n in range(1, len(s) + 1) if re.fullmatch(pattern, s[:n])), default=0)
            assert secret_scan.Scanner._longest(dfa, s.encode()) == best


def test_secret_query_and_redaction(spark):
    got = rows_of(secret_scan.find_secrets(documents(spark)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    kinds, exp = ("assign", "access", "hex"), []
    for d, t in TEXTS:
        b = base_secrets(t)
        exp.append((d, *(sum(x[0] == k for x in b) for k in range(3)), sha(",".join(f"{kinds[k]}:{a}:{z}" for k, a, z in b))))
    assert got == sorted(exp, key=str)
    docs = documents(spark).withColumnRenamed("n_tokens", "n_chars")
    clean = {(r.doc_id, r.n_chars): r.text for r in secret_scan.redact(docs).collect() if r.text is not None}
    assert not any(base_secrets(t) for t in clean.values()) and all(n == len(t) for (_, n), t in clean.items())
    assert secret_scan.redact(docs).columns == docs.columns
    assert secret_scan.find_secrets(documents(spark, [])).count() == 0


def test_kgram_hash_is_the_polynomial():
    h = np.random.default_rng(0).integers(0, 1 << 63, 40).astype("u8")
    base = 0x9E3779B97F4A7C15
    for k in (1, 2, 5, 18, 35, 40):
        exp = [sum(int(x) * pow(base, k - 1 - j, 1 << 64) for j, x in enumerate(h[i : i + k])) % (1 << 64) for i in range(41 - k)]
        assert kgrams(h, k).tolist() == exp
