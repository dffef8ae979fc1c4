"""Words, token ids, binary files, packing and edits, against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cambist.llm import edit_counts, packing, token_files
from cambist.llm.elias_fano import EliasFano
from cambist.llm.encoding import BYTE_VOCABULARY, WORD_VOCABULARY, Encoder, vocabulary_path
from cambist.llm.words import Words

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, "  ", " a  b\n\n c ", "x", "don't 'S it's  ", "a\x1cb \x1d c", "x  \n y", "İx ª Straße ÿ.", "<|endoftext|> a", "x <|ENDOFTEXT|><|startoftext|> y  <| z", "x<|endoftext|>  \n y", "tab\t\tx \r\n y ", "“q”—z ’s", "x" * 5000]


def plain(name):
    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t.", max_size=30)), max_size=8))
@settings(max_examples=100, deadline=None)
def test_words(texts):
    words = Words(pa.array(texts, pa.string()))
    want = [SPLIT.findall(t or "") for t in texts]
    assert [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end)] == [w for ws in want for w in ws]
    assert words.counts.tolist() == [len(w) for w in want]
    joined, bounds = words.joined()
    assert [joined[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])] == [" ".join(w) for w in want]
    names = defaultdict(set)
    for w, code in zip((w for ws in want for w in ws), words.code.tolist()):
        names[w].add(code)
    assert all(len(c) == 1 for c in names.values()) and len({min(c) for c in names.values()}) == len(names)


def test_codes_do_not_depend_on_place_or_length():
    long = "w" * 300
    text = " ".join([long, "a"] * 9000)  # more than one segment
    words = Words(pa.array(["a", text, long]))
    assert len(set(words.code.tolist())) == 2


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_ids_equal_the_library_s(name):
    own, want = Encoder(name), plain(name)
    for texts in (ODD, ODD[::-1], [], [""]):
        ids, bounds = own.documents(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [want(t) + [1] for t in texts]


def thue_morse(length: int, a="a", b="b") -> str:
    """The letter of a place says whether its number has an odd count of set bits: sums of powers modulo 2**64 cancel."""
    return "".join(b if bin(i).count("1") % 2 else a for i in range(length))


@pytest.mark.parametrize("name", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_patterned_words_keep_their_own_ids(name):
    texts = [t for n in (64, 512, 1024, 2048, 4096) for t in (thue_morse(n), thue_morse(n, "b", "a"), thue_morse(n, "x ", "y "), thue_morse(n, "y ", "x "))]
    words = Words(pa.array(texts))
    assert len(set(words.code[words.counts.cumsum()[words.counts == 1] - 1].tolist())) == 10
    whole = words.runs(words.first[:-1], words.first[1:])
    assert len(set(whole.tolist())) == len(texts)
    own, want = Encoder(name), plain(name)
    for _ in range(2):  # learned, then kept
        ids, bounds = own.documents(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [want(t) + [1] for t in texts]


def test_equal_codes_of_different_stretches(monkeypatch):
    """Were codes to collide, bytes decide."""
    own, want = Encoder(WORD_VOCABULARY), plain(WORD_VOCABULARY)
    texts = pa.array(["one two three", "two one two", "x" * 100 + " " + "y" * 100])
    data, start, end, code, first = own.stretches(texts)
    numbers = own.numbers(data, start, end, np.zeros_like(code))
    got = [own.flat[own.bounds[n] : own.bounds[n + 1]].tolist() for n in numbers.tolist()]
    assert got == [want(data[a:b].tobytes().decode()) for a, b in zip(start, end)]


@given(st.lists(st.text(alphabet="aZé. \n\t'3! \x1c", max_size=25), max_size=6))
@settings(max_examples=80, deadline=None)
def test_ids_of_any_text(texts):
    for name, own, want in TOKENIZERS:
        ids, bounds = own.documents(pa.array(texts, pa.string()), end_id=None)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [want(t) for t in texts]


TOKENIZERS = [(n, Encoder(n), plain(n)) for n in (WORD_VOCABULARY, BYTE_VOCABULARY)]


@given(st.lists(st.integers(-(2**40), 2**40), max_size=600))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values):
    values = np.sort(np.array(values, np.int64))
    again, _ = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    assert again.all().tolist() == values.tolist()
    assert [again.select(i) for i in range(len(values))] == values.tolist()


def test_many_selects():
    values = np.cumsum(np.random.default_rng(2).integers(0, 900, 3000)) - 50_000
    again, _ = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    for places in (np.arange(3000), np.array([2999, 0, 255, 256, 257, 256, 1024]), np.array([], int)):
        assert again.select_many(places).tolist() == values[places].tolist()
    for places in ([-1], [0, 3000]):
        with pytest.raises(IndexError):
            again.select_many(places)


def test_rows_are_read_by_the_select_directory(monkeypatch):
    ends = np.arange(1, 701) * 3
    data = token_files.shard_bytes([None, *range(699)], ends, np.arange(2100) % 50)
    whole = EliasFano.all
    monkeypatch.setattr(EliasFano, "all", lambda self: whole(self) if self.n == 699 else pytest.fail("all ends were decoded"))
    rows = token_files.shard_rows("s", token_files.Shard(data), 50)
    assert rows.column("start").to_pylist() == (ends - 3 + 50).tolist() and set(rows.column("n_tokens").to_pylist()) == {3}
    assert rows.column("ids_crc32")[1].as_py() == crc([3, 4, 5])


def test_bounds_take_little_space():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 3000, 20_000))
    assert len(EliasFano.of(ends).to_bytes()) * 8 < 16 * len(ends)


def test_token_files(spark, documents, tmp_path):
    rows = [(7, "the cat sat"), (3, None), (None, "no id"), (3, "again"), (9, ""), (1, "x " * 3000), (7, "the cat sat"), (-5, "minus")]
    want, ids_of, start = [], plain(WORD_VOCABULARY), 0
    frame = token_files.encode_to_files(documents(rows), str(tmp_path / "ids"), shard_ids=50)
    got = [tuple(r)[:4] for r in frame.orderBy("start").collect()]
    assert [g[0] for g in got] == [None, -5, 1, 3, 3, 7, 7, 9]
    left = list(rows)
    for doc_id, *rest in got:
        found = next(r for r in left if r[0] == doc_id and crc(ids_of(r[1]) + [1]) == rest[2])
        left.remove(found)
        want.append((doc_id, start, len(ids_of(found[1])) + 1, rest[2]))
        start += want[-1][2]
    assert got == want and not left
    shards = sorted(p for p in (tmp_path / "ids").iterdir() if p.suffix == token_files.SUFFIX)
    assert len(shards) > 2
    shard = token_files.Shard(shards[0].read_bytes())
    assert shard.doc_ids()[0] is None and shard.document(0).tolist() == ids_of("no id") + [1]


def test_token_files_of_nothing(spark, documents):
    assert token_files.encode_to_files(documents([])).count() == 0


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_plan_covers_the_demand(n):
    size = packing.lengths(2048, 32)
    demand = np.bincount(np.random.default_rng(n).integers(0, len(size), n), minlength=len(size))
    plan = packing.plan_sequences(demand)
    assert (sum((x * c for x, c in plan), np.zeros(len(size), int)) == demand).all()
    assert all((c * size).sum() <= 2048 for _, c in plan)
    assert sum(x for x, _ in plan) <= 1.03 * (demand * size).sum() / 2048 + 2


def test_best_pattern_is_optimal():
    random_ = np.random.default_rng(3)
    for _ in range(20):
        values = random_.random(9)
        best = [0.0]
        for c in range(1, 10):
            best.append(max([best[c - 1]] + [best[c - s] + values[s - 1] for s in range(1, c + 1)]))
        worth, counts = packing.best_pattern(values, 9)
        assert worth == pytest.approx(best[9]) and (counts * np.arange(1, 10)).sum() <= 9 and counts @ values == pytest.approx(worth)


def test_packing(spark, documents):
    rows = [(i, "the quick brown fox " * (i * 7 % 400)) for i in range(60)] + [(None, "no id"), (3, None), (3, "twice"), (3, "twice"), (99, "")]
    pieces = packing.pack(documents(rows)).collect()
    ids_of, groups, sequences = plain(BYTE_VOCABULARY), defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        groups[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = ids_of(text) + [1]
        starts = sorted({s for s, _, _ in groups[doc_id, len(ids)]})
        for a, b in zip(starts, starts[1:] + [len(ids)]):
            want[doc_id, len(ids)].append((a, b - a, crc(ids[a:b])))
    assert {k: sorted(v) for k, v in groups.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(documents([])).count() == 0


def test_edits_keep_counts_exact():
    tokenizer = Encoder(BYTE_VOCABULARY).tokenizer
    count, rnd = plain(BYTE_VOCABULARY), random.Random(4)
    letters = [b"a", b"B", b" ", b"  ", b"\n", b".", b"the", b" is", b"\t", b"1", b"'s", " ".encode()]
    for _ in range(150):
        text = b"".join(rnd.choice(letters[:-1]) for _ in range(rnd.randint(0, 30)))
        parts = re.findall(rb"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+", text)
        tree = edit_counts.CountTree(parts, [len(count(p.decode())) for p in parts], tokenizer)
        for _ in range(rnd.randint(1, 8)):
            a = rnd.randint(0, len(text))
            b, new = min(len(text), a + rnd.randint(0, 6)), b"".join(rnd.choice(letters) for _ in range(rnd.randint(0, 3)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == len(count(text.decode("utf-8", "replace")))


def test_edited_counts(spark, documents):
    long = "word " * 2000
    rows = [(1, f"{long} write to a.b@c.org or +49 30 1234567 now {long}"), (2, "no data"), (3, None), (4, ""), (4, "x@y.zz")]
    count = plain(BYTE_VOCABULARY)
    got = {(r.doc_id, r.tokens_before): r for r in edit_counts.edited_counts(documents(rows)).collect()}
    assert len(got) == 5
    for doc_id, text in rows:
        row = got[doc_id, len(count(text))]
        new = (text or "").encode()
        for a, b, instead in edit_counts.redactions(new):
            new = new[:a] + instead + new[b:]
        assert row.tokens_after == len(count(new.decode()))
    assert got[1, len(count(rows[0][1]))].n_edits == 2 and got[1, len(count(rows[0][1]))].n_reencoded < 30


def test_redactions_against_patterns():
    """The same spans as plain patterns tried at every place."""
    plain_patterns = (
        (re.compile(rb"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"), b"<email>"),
        (re.compile(rb"https?://[^\s<>]+"), b"<url>"),
        (re.compile(rb"\+?[0-9][0-9 ().-]{6,}[0-9]"), b"<number>"),
    )
    rnd = random.Random(8)
    parts = [b"a", b"b.c", b"@", b".", b"org", b" ", b"+", b"49", b"1234567", b"(0)", b"https://", b"x-", b"<", b"8 ", b"--"]
    for _ in range(3000):
        text = b"".join(rnd.choice(parts) for _ in range(rnd.randint(0, 18)))
        found, taken = [], []
        for pattern, instead in plain_patterns:
            for m in pattern.finditer(text):
                if not any(a < m.end() and m.start() < b for a, b in taken):
                    taken.append(m.span())
                    found.append((*m.span(), instead))
        assert edit_counts.redactions(text) == sorted(found, reverse=True), text


@pytest.mark.parametrize("text", [b"x" * 2_000_000, b"a@b.cd " * 100_000, b"1" * 2_000_000, b"a." * 500_000 + b"@", b"1 +" * 500_000])
def test_redactions_take_linear_time(text):
    import time

    begin = time.process_time()
    edit_counts.redactions(text)
    assert time.process_time() - begin < 20


def test_edits_of_texts_with_special_tokens():
    own, count = Encoder(BYTE_VOCABULARY), plain(BYTE_VOCABULARY)
    for text in ("x <|endoftext|> y", "x <|endof text", "<| a@b.org <|endoftext|>"):
        data, start, end, code, _ = own.stretches(pa.array([text]))
        numbers = own.numbers(data, start, end, code)
        tree = edit_counts.CountTree([data[a:b].tobytes() for a, b in zip(start, end)], (own.bounds[numbers + 1] - own.bounds[numbers]).tolist(), own.tokenizer)
        assert tree.total == len(count(text))
        tree.edit(2, 3, b"<|endoftext|><")
        assert tree.total == len(count(text[:2] + "<|endoftext|><" + text[3:]))
