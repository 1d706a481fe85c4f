"""Language identification, periodic runs and tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.alignment import align_corpus, aligner
from tidemark.llm.catalog import QUERIES
from tidemark.llm.language import codewords, gram_shares, identify, learned_rows, train
from tidemark.llm.periods import find_runs, runs_of

SCHEMA = "doc_id long, text string, lang string, start string, pairs string, lang_pred string"
ENDINGS = {"en": "the ing tion of and er ly th", "de": "der die sch ung und ein keit ich", "fr": "les que eux ment elle une tre oi"}


def prose(rng: random.Random, lang: str, count: int) -> str:
    parts = ENDINGS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(count))


def rows(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    found = []
    for k in range(120):
        lang = rng.choice(list(ENDINGS))
        found.append((k, prose(rng, lang, rng.choice([3, 20, 80])), lang))
    found[7] = (7, prose(rng, "de", 9000), "de")
    found[8] = (8, found[9][1], found[9][2])
    found += [(130, "", "en"), (131, None, "fr"), (132, "12 34 !", None), (133, "word " * 40, "en"), (134, " \t\n", "de")]
    found += [(None, found[3][1], found[3][2]), found[4], found[4], (None, None, None)]
    found += [(140, "é▁x", "fr"), (141, "<|endoftext|> <s> a\n\n b\t c  ", "en"), (142, "日本語 テスト 😀", "en"), (143, "  two  spaces ", "en")]
    return [(doc, text, lang, "x", "y", "z") for doc, text, lang in found]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{path}/documents.parquet")
    return path


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# periodic runs


def smallest_period(words: list) -> int:
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i - q] for i in range(q, len(words))))


def runs_by_brute_force(words: list) -> list[tuple[int, int, int]]:
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and smallest_period(words[i - q : j]) == q:
                found.add((i - q, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 8)), max_size=6))
def test_runs_are_those_of_brute_force(parts):
    words = [w for base, times in parts for w in base * times]
    assert runs_of(np.array(words, np.int64)) == runs_by_brute_force(words)


def test_runs_of_hot_words_cost_little():
    assert runs_of(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def expected_runs(doc, text):
    words = split(text)
    number = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), number // 10
    if number % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_brute_force(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_op12_query_is_brute_force(spark, folder):
    short = [r for r in rows() if r[0] != 7]
    found = {tuple(r) for r in QUERIES["op12_periods"](spark, folder).collect()}
    assert {expected_runs(r[0], r[1]) for r in short} == {r for r in found if r[0] != 7}
    assert len(found) == len({r[:2] for r in rows()})


def test_runs_keep_texts_and_edges(spark, docs, nothing):
    assert find_runs(nothing).count() == 0
    found = {r.doc_id: r for r in find_runs(docs).collect()}
    assert found[133].runs == [(0, 40, 1)] and found[133].text == "word" and found[133].exponent_milli == 40_000
    assert found[131].n_runs == 0 and found[131].text == "" and found[131].start is None


# alignment


@lru_cache(maxsize=1)
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def tokens(text):
    a, b = tokenizers()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    bytes_a = [bytes(letters[c] for c in t) for t in ids_a.tokens]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
    ]
    if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    return list(zip(ids_a.ids, bytes_a, strict=True)), list(zip(ids_b, bytes_b, strict=True))


def spans(found):
    at, out = 0, []
    for token, data in found:
        out.append((token, at, at + len(data)))
        at += len(data)
    return out


def expected_alignment(texts):
    each = []
    for text in texts:
        found = tokens(text) if text else None
        if found is None:
            each.append(None)
            continue
        a, b = spans(found[0]), spans(found[1])
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        of = lambda side, low, high: ",".join(str(t) for t, s, e in side if s >= low and e <= high)
        groups = ";".join(of(a, low, high) + "|" + of(b, low, high) for low, high in zip([0, *shared], shared, strict=False))
        links = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        each.append((len(a), len(b), len(shared), groups, links))
    counts = Counter(link for found in each if found for link in found[4])
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for found in each:
        if found is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            *head, groups, links = found
            yield (*head, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), groups)


@pytest.mark.parametrize("share", [2.0**-18, 0.01, 2.0])
def test_alignment_is_brute_force(spark, docs, nothing, monkeypatch, share):
    """Whatever the share from which pairs are broadcast: all, some or none of them."""
    monkeypatch.setattr("tidemark.llm.alignment.HEAVY_SHARE", share)
    short = docs.where("doc_id is null or doc_id <> 7")
    given_rows = [tuple(r) for r in short.select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in align_corpus(short).collect())
    wanted = expected_alignment([text for _, text in given_rows])
    assert found == Counter((doc, *row) for (doc, _), row in zip(given_rows, wanted, strict=True))
    assert align_corpus(nothing).count() == 0


def test_op13_query_hashes_the_groups(spark, docs, folder):
    whole = {(r.doc_id, r.n_a): r for r in align_corpus(docs).collect()}
    found = QUERIES["op13_alignment"](spark, folder).collect()
    assert len(found) == len(rows())
    for row in found:
        other = whole[row.doc_id, row.n_a]
        assert row.count_sum == other.count_sum and row.n_best == other.n_best
        assert row.groups_sha256 == (hashlib.sha256(other.groups.encode()).hexdigest() if row.n_a else "")


# language identification


def test_codewords_lie_apart():
    for count in (2, 3, 5, 9, 40):
        code = codewords(count)
        assert min((code[i] != code[j]).sum() for i in range(count) for j in range(i)) >= max(1, code.shape[1] // 4)
        assert all(0 < (column > 0).sum() < count for column in code.T)


def test_gram_shares_count_every_gram():
    text = "Aé  b\n" * 30
    data = (" " + " ".join(text.lower().split()) + " ").encode()
    counted = Counter()
    for n in range(1, 4):
        for i in range(len(data) - n + 1):
            code = int.from_bytes(b"\x01" + data[i : i + n], "big") & 0xFFFFFFFF
            counted[(code * 2654435761 & 0xFFFFFFFF) >> 17] += 1
    grams, shares = gram_shares(text)
    total = sum(counted.values())
    assert {int(g): round(s * total / 100) for g, s in zip(grams, shares, strict=True)} == counted


def test_chunks_of_long_texts_change_nothing(monkeypatch):
    text = prose(random.Random(2), "fr", 3000)
    whole = gram_shares(text)
    monkeypatch.setattr("tidemark.llm.language.CHUNK", 1000)
    for one, other in zip(whole, gram_shares(text), strict=True):
        assert (one == other).all()


def test_language_of_held_out_documents(spark, docs, folder):
    found = QUERIES["op11_language"](spark, folder).collect()
    assert len(found) == len(rows())
    known = {r[0]: r[2] for r in rows() if r[0] is not None}
    held = [r for r in found if r.held_out and r.doc_id < 120]
    assert len(held) > 10 and sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) >= 0.9
    for row in found:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert {130, 131, 132, 134} <= und and 133 not in und


def test_language_learns_from_its_rows_alone(spark, docs):
    """Labels of held-out rows, other columns and ids change no prediction."""
    changed = spark.createDataFrame(
        [(r[0], r[1], "xx" if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2 else r[2], *r[3:]) for r in rows()], SCHEMA
    )
    one, other = (train(learned_rows(d)) for d in (docs, changed))
    assert one.languages == other.languages == sorted(ENDINGS)
    assert (one.weights == other.weights).all() and (one.bias == other.bias).all()


def test_language_of_odd_tables(spark, docs, nothing):
    nobody = train(learned_rows(nothing))
    assert {(r.lang_pred, r.score) for r in identify(docs, nobody).collect()} == {("und", 0.0)}
    assert identify(nothing, train(learned_rows(docs))).count() == 0
    single = train(learned_rows(docs.where("lang = 'de'")))
    assert {r.lang_pred for r in identify(docs, single).collect()} == {"de", "und"}


def test_alignment_takes_no_python_step_for_each_new_word():
    from pathlib import Path

    import public_tokenizers

    described = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    align = aligner(described, Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())
    rng, calls = random.Random(4), []
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(3000))
    sys.setprofile(lambda frame, event, _: calls.append(event) if event == "call" else None)
    try:
        found = align.document(text)
    finally:
        sys.setprofile(None)
    assert found[2] >= 1000 and found[3].count(b"|") == found[2] and len(calls) < 500
