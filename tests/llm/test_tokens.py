import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import plan_text
from wardflow.llm import bpe, joins, packing, token_counts
from wardflow.llm.tokens import Encoder

SCHEMA = "doc_id bigint, text string, ids string, length int"
BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts():
    rng = random.Random(1)
    out = [
        "", "<|endoftext|>", " <|endoftext|> x", "a<|endoftext|>b  <|startoftext|>\n\n", "  lead", "tail \n",
        "a  b", "x\x1cy \x1f z", "á ́b", "漢字かな交じり文 テスト" * 50, "a" * 3000, "ab" * 2000 + " " + "!" * 1500,
        "\n" * 700 + " " * 900 + "x", "é" * 999, "ΑΣ ΣΑΣ İI", "don't we'll 'S THEY'RE", " a  b", "1234567" * 100,
        "😀" * 400, "ª. º, µ: ²! ß. ÀÉ.", "x." * 300, "a" * 300 + "<|endoftext|>" + "b" * 300, "\r\n\tq w e",
    ]
    out += ["".join(rng.choices(" \n\t'aZé漢1!́.,", k=rng.randrange(60))) for _ in range(400)]
    return out + ["".join(rng.choices(["th", "e", "in", "g", "ing", "tion"], k=500)) for _ in range(20)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(path):
    library, own = Tokenizer.from_file(path), Encoder(open(path).read())
    texts = odd_texts()
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at:at + 50], own.encode(texts[at:at + 50])):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_in_another_case_are_text(path):
    library, own = Tokenizer.from_file(path), Encoder(open(path).read())
    texts = [
        "<|ENDOFTEXT|>", "Some <|EndOfText|> É text", "A<|endoftext|>B <|STARTOFTEXT|>.", "<|endoftext|> Plain TEXT",
        "X" * 400 + "<|EndOfText|>" + "y" * 400, "漢 <|ENDOFTEXT|>\nz",
    ]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_of_many_new_chunks_equal_the_library(path):
    library, own = Tokenizer.from_file(path), Encoder(open(path).read())
    rng = random.Random(8)
    letters = "aeZÉß漢́1!.,'’\t\x1c\x85\u00a0\u3000\u1100\u1161\u0345Σ😀" + "st"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(300)) for _ in range(60)]
    texts += [t.replace(" ", "\n") for t in texts[:20]]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_tree_of_halves_equals_the_whole():
    own = Encoder(open(BYTE).read())
    assert joins.encode_long("", own.model) == []
    rng = random.Random(3)
    for letters in ("ab", "etaoin", "a", "!?-=", "0123"):
        text = "".join(rng.choices(letters, k=1500))
        for leaf in (1, 3, 64):
            assert joins.encode_long(text, own.model, leaf) == own.model(text)


def test_round_trip_equals_the_library(frame):
    library = Tokenizer.from_file(BYTE)
    rows = [(i, t, "x", 1) for i, t in enumerate(odd_texts())] + [(None, None, None, None), (1, "again", "", 0)]
    df = frame(rows, SCHEMA)
    got = sorted(map(str, bpe.round_trip(df, "doc_id", "text", BYTE).collect()))
    expected = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), back)]
        expected.append(f"Row(id={i}, n_tokens={len(ids)}, ids_sha256='{digest[0]}', decoded_sha256='{digest[1]}')")
    assert got == sorted(expected)
    texts = bpe.decode(bpe.encode(df, "doc_id", "text", BYTE), "id", "ids", BYTE).collect()
    assert sorted(map(str, texts)) == sorted(f"Row(id={i}, text={(t or '')!r})" for i, t, *_ in rows)
    assert bpe.round_trip(frame([], SCHEMA), "doc_id", "text", BYTE).count() == 0


def test_histogram_answers_every_limit(frame, monkeypatch):
    monkeypatch.setattr(token_counts, "RANGE", 7)
    library = Tokenizer.from_file(BYTE)
    texts = odd_texts() + [None, ""]
    df = frame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)
    sizes = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for t in texts])
    found = token_counts.histogram(token_counts.encoded_lengths(df, "text", BYTE))
    rows = found.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes.tolist()))
    for r in rows:
        n = r.length
        assert (r.docs, r.docs_at_least, r.tokens_at_least, r.docs_total, r.tokens_total, r.truncated_total) == (
            (sizes == n).sum(), (sizes >= n).sum(), sizes[sizes >= n].sum(), len(sizes), sizes.sum(),
            np.minimum(sizes, n).sum())
        assert r["quantile"] == (sizes <= n).mean()
    for limit in (0, 5, 40, 10**6):
        assert tuple(token_counts.at_limit(found, limit).first()) == (
            (sizes > limit).sum(), np.minimum(sizes, limit).sum(), sizes.sum())
    assert token_counts.quantile(found, 0.5).first()[0] == np.sort(sizes)[-(-len(sizes) // 2) - 1]
    assert "MapInArrow" not in plan_text(found)  # encoded once, when the counts were stored
    empty = token_counts.histogram(token_counts.encoded_lengths(frame([], SCHEMA), "text", BYTE))
    assert empty.count() == 0


def check_packing(rows, documents, tiers):
    sequences, covered = {}, {}
    for r in rows:
        ids = documents[r.id]
        piece = np.array(ids[r.start:r.start + r.length], "<u4")
        assert r.length == len(piece) > 0 and r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(piece.tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.window, r.step_group))
        covered.setdefault(r.id, []).append((r.start, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length, window, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == window <= tiers[-1] and at & (at - 1) == 0
        assert len({p[3] for p in parts}) == 1
    assert set(covered) == set(documents)
    for name, parts in covered.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(documents[name])


@pytest.mark.parametrize("unit", [200, 1 << 20])
def test_packing_has_every_id_once_and_no_padding(frame, monkeypatch, unit):
    monkeypatch.setattr(packing, "UNIT", unit)
    library = Tokenizer.from_file(WORD)
    texts = odd_texts()[:120] + ["word " * 9000, None, "", "short"]
    df = frame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)
    rows = packing.pack(df, "doc_id", "text", WORD, with_ids=True).collect()
    documents = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    check_packing(rows, documents, packing.TIERS)
    assert all(r.ids == documents[r.id][r.start:r.start + r.length] for r in rows)
    assert packing.pack(frame([], SCHEMA), "doc_id", "text", WORD).count() == 0


def test_long_windows_are_filled_before_documents_are_cut():
    windows = packing.pack_unit([1500, 500, 48, 1024, 200, 56, 3000])
    full = sorted(tuple(sorted(p[0] for p in w)) for w in windows)
    assert (48, 500, 1500) in full
    assert all(sum(w) & (sum(w) - 1) == 0 for w in full)


def test_step_groups_balance_cost():
    rng = random.Random(2)
    windows = packing.pack_unit([rng.randrange(1, 3000) for _ in range(900)])
    groups = packing.step_groups(windows)
    cost, size = {}, {}
    for w, g in zip(windows, groups):
        size.setdefault(g, set()).add(sum(p[0] for p in w))
        cost.setdefault(g, []).append(sum(p[0] ** 2 for p in w))
    assert all(len(s) == 1 for s in size.values())
    full = [sum(c) for g, c in cost.items() if size[g] == {2048} and len(c) == packing.STEP // 2048]
    assert len(full) > 2 and max(full) < 1.25 * min(full)


def test_tiers_must_be_powers_of_two(frame):
    with pytest.raises(ValueError):
        packing.pack(frame([], SCHEMA), "doc_id", "text", WORD, tiers=(100, 200))
