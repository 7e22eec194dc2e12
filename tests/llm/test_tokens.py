"""Token operators: unit encoding, packing, token counts and Re-Pair files against the library."""

import io
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from carelake.llm import counts, files, packing, repair, tokens  # noqa: E402
from carelake.session import scratch_path  # noqa: E402

cloudpickle.register_pickle_by_value(cases)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_units_give_the_ids_of_whole_texts(library):
    rng = random.Random(1)
    pieces = ["a", "b9", "Ab", "é", " ", " ", "\n", "\t", " ", "　", "'s", "'", ".", "--", "日本", "\U0001f600", "\x01", "\x1c", "<|endoftext|>", "3", "_", "\r"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(3_000)] + [None, ""]
    ids, off = tokens.Encoder(tokens.BYTE_BPE).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == library(text), repr(text)


def test_small_cache_gives_equal_ids(library):
    rng = random.Random(2)
    encoder = tokens.Encoder(tokens.BYTE_BPE, cache_bytes=5_000)
    for _ in range(20):
        texts = [cases.prose(rng, 40, 5_000) for _ in range(5)]
        ids, off = encoder.encode(pa.array(texts))
        assert [ids[off[i] : off[i + 1]].tolist() for i in range(5)] == [library(t) for t in texts]


def test_units_of_letters_meet_one_pattern(library, monkeypatch):
    looked_at = []
    match = pc.match_substring_regex
    monkeypatch.setattr(tokens.pc, "match_substring_regex", lambda texts, pattern: looked_at.append(len(texts)) or match(texts, pattern))
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefghiÄé", k=rng.randint(1, 9))) for _ in range(400)) + " 1.5 end.\n"
    encoder = tokens.Encoder(tokens.BYTE_BPE)
    looked_at.clear()
    units = encoder.units(pa.array([text]))
    assert sum(looked_at) < 2 * (len(units.piece_off) - 1)
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == library(text)


def test_special_strings_of_letters_cut_units_of_letters(tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.add_special_tokens(["stop"])
    plain.save(str(tmp_path / "special.json"))
    texts = ["do not stop here", "unstoppable", "stop", "no"]
    ids, off = tokens.Encoder(str(tmp_path / "special.json")).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("clashing", [False, True])
def test_token_counts(spark, library, clashing):
    rows = cases.edge_rows()
    got = cases.collected(counts.token_counts(cases.documents(spark, rows, clashing)))
    want = [(r[0], len((r[1] or "").encode()), len(library(r[1])), len(library(r[1])) > 1024) for r in rows]
    assert got == sorted(want, key=repr)
    assert counts.token_counts(cases.documents(spark, [])).count() == 0


def check_pieces(got, rows, library, window):
    """Every id in exactly one piece; sequences gapless and full, or a power of two long."""
    want = sorted(((r[0], crc(library(r[1]) + [0]), len(library(r[1])) + 1) for r in rows), key=repr)
    sequences, pieces = {}, {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        pieces.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    texts = {}
    for r in rows:
        ids = library(r[1]) + [0]
        texts.setdefault((r[0], len(ids)), []).append(ids)
    assert set(texts) == set(pieces)
    for key, copies in texts.items():
        if len({tuple(c) for c in copies}) == 1:
            for p in pieces[key]:
                assert p.ids_crc32 == crc(copies[0][p.start : p.start + p.length])
        assert sum(p.length for p in pieces[key]) == sum(map(len, copies))
    assert sum(p.length for p in got) == sum(w[2] for w in want)


@pytest.mark.parametrize("clashing", [False, True])
def test_packing_covers_every_id_once(spark, library, clashing):
    rows = cases.edge_rows()
    check_pieces(packing.pack(cases.documents(spark, rows, clashing)).collect(), rows, library, 1024)
    assert packing.pack(cases.documents(spark, [])).count() == 0


def test_packing_many_documents(spark, library):
    rng = random.Random(3)
    rows = [(i, cases.prose(rng, rng.choice([3, 50, 200, 700])), "en", "s", 1) for i in range(300)]
    got = packing.pack(cases.documents(spark, rows).repartition(3)).collect()
    check_pieces(got, rows, library, 1024)
    whole = sum(1 for p in got if p.length == p.doc_tokens)
    assert whole > 0.8 * sum(1 for r in rows if len(library(r[1])) < 1024)


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(4)
    packer = packing.Packer(0, window=16)
    for doc in range(400):
        n = rng.randint(1, 15)
        before = packer.counts.copy()

        def squares(h, before=before, n=n):
            after = before.copy()
            if h:
                after[h] -= 1
            if h + n < 16:
                after[h + n] += 1
            return int((after[1:16] ** 2).sum())

        options = [h for h in range(0, 17 - n) if h == 0 or before[h]]
        level = packer.level(n)
        assert squares(level) == min(map(squares, options))
        packer.add(doc, np.arange(n, dtype=np.uint32))
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum(p for p in [r[2] for r in packer.rows])


@pytest.mark.parametrize("clashing", [False, True])
def test_repair_files_round_trip(spark, library, clashing):
    rows = cases.edge_rows()
    got = cases.collected(repair.roundtrip(cases.documents(spark, rows, clashing)))
    first = lambda r: (r[0] is not None, r[0] or 0)
    ids = sorted(((first(r), library(r[1]) + [0]) for r in rows), key=lambda x: x[0])
    assert sorted((g[0] is not None, g[0] or 0, g[2], g[3]) for g in got) == sorted((*k, len(i), crc(i)) for k, i in ids)
    at = 0
    for g in sorted(got, key=lambda g: g[1]):
        assert g[1] == at
        at += g[2]
    order = [(g[0] is not None, g[0] or 0) for g in sorted(got, key=lambda g: g[1])]
    assert order == sorted(order)
    assert repair.roundtrip(cases.documents(spark, [])).count() == 0


def test_blocks_are_a_grammar_with_random_access():
    rng = np.random.default_rng(6)
    phrase = rng.integers(0, 50_000, 40).astype(np.uint32)
    parts = [np.concatenate([phrase[a : a + 20] for a in rng.integers(0, 20, n)] + [np.zeros(1, np.uint32)]) for n in (1, 50, 200, 3)] + [np.zeros(1, np.uint32), np.full(999, 7, np.uint32)]
    data = repair.encode_block([1, None, 3, 4, 5, 6], parts)
    sizes = np.frombuffer(data, "<u8", 6)
    assert sizes[2] > 10 and sizes[1] < sum(map(len, parts)) / 2
    stream = type("Stream", (), {"at": 0, "read": lambda self, n: (data[self.at : self.at + n], setattr(self, "at", self.at + n))[0]})()
    (block,) = repair.blocks(stream)
    assert block.doc_ids == [1, None, 3, 4, 5, 6]
    for i in (5, 0, 3, 2, 4, 1):
        assert (block.document(i) == parts[i]).all()
    assert [d.tolist() for d in block.documents()] == [p.tolist() for p in parts]
    lens = repair.expansion_lengths(block.rules[:, :2])
    assert (lens == block.rules[:, 2]).all() and lens.max() > 4


def test_blocks_stay_bounded(spark, library):
    rng = random.Random(7)
    rows = [(i, cases.prose(rng, 100), "en", "s", 1) for i in range(60)]
    folder = scratch_path(spark, "repair-test")
    manifest = repair.write(cases.documents(spark, rows), folder, block_ids=1_000).collect()
    n_blocks = 0
    for m in manifest:
        with files.reader(folder, m.file) as stream:
            n_blocks += sum(1 for _ in repair.blocks(stream))
    assert n_blocks > 5 and sum(m.documents for m in manifest) == 60


def test_pairs_sort_alike_with_places_of_any_width(monkeypatch):
    rng = np.random.default_rng(8)
    parts = [rng.integers(65_000, 65_536, 3_000).astype(np.uint32), np.tile(rng.integers(0, 9, 50), 40).astype(np.uint32), np.zeros(500, np.uint32)]
    packed = repair.encode_block([1, 2, 3], parts)
    monkeypatch.setattr(repair, "_PLACE_BITS", 3)
    assert repair.encode_block([1, 2, 3], parts) == packed


@pytest.mark.parametrize("vocabulary", [1, 3, 40, 2000])
def test_rounds_count_only_pairs_beside_replacements(vocabulary, monkeypatch):
    rng = np.random.default_rng(vocabulary)
    parts = [rng.integers(0, vocabulary, n).astype(np.uint32) for n in rng.integers(1, 300, 200)]
    parts = [np.concatenate((p, p[: len(p) // 2])) for p in parts]
    hashed, bucket = [], repair._bucket
    monkeypatch.setattr(repair, "_bucket", lambda left, right: hashed.append(len(left)) or bucket(left, right))
    ids = np.concatenate(parts)
    symbols, firsts, _ = repair.replace_pairs(ids, np.cumsum([0] + [len(p) for p in parts[:-1]]), least=4)
    # all pairs once, then two for each pair replaced, of which every one leaves one symbol less
    assert hashed[0] == len(ids) - 1 and sum(hashed[1:]) <= 2 * (len(ids) - len(symbols))
    left = Counter()
    for a, b in zip(firsts, [*firsts[1:], len(symbols)], strict=True):
        left.update(zip(symbols[a : b - 1].tolist(), symbols[a + 1 : b].tolist(), strict=True))
    assert not [p for p, n in left.items() if n >= 4]
    decoded = [d.tolist() for block in repair.blocks(io.BytesIO(repair.encode_block([*range(200)], parts))) for d in block.documents()]
    assert decoded == [p.tolist() for p in parts]



def test_a_late_attempt_leaves_the_committed_file(tmp_path, monkeypatch):
    """Attempts commit twice and die in between; a file of other bytes is replaced."""

    def attempt(data):
        out = files.Committed(str(tmp_path), "a.bin")
        out.write(data)
        return out

    late = attempt(b"same bytes")
    attempt(b"same bytes").commit()
    written = (tmp_path / "a.bin").stat().st_mtime_ns

    class Lost:
        def __getattr__(self, name):
            if name in ("move", "delete_file"):
                return self._fail
            return getattr(late_fs, name)

        def _fail(self, *_):
            raise OSError("lost")

    late_fs = late.fs
    late.fs = Lost()
    with pytest.raises(OSError):
        late.commit()
    assert (tmp_path / "a.bin").read_bytes() == b"same bytes"
    attempt(b"same bytes").commit()
    assert (tmp_path / "a.bin").stat().st_mtime_ns == written
    attempt(b"same-bytes").commit()
    assert (tmp_path / "a.bin").read_bytes() == b"same-bytes"
