"""Words, shingles and token ids against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from anteframe.llm import _text as t
from anteframe.llm._tokens import Encoder, cut, default_files

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abZ 1\n\té漢|-\x00", max_size=30)), max_size=6)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, off = t.text_bytes(pa.array(texts, pa.string()))
    for parting, pattern in ((t.BLANKS, rb"[^\x20\x09-\x0D]+"), (t.NOT_ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = t.Words(data, off, parting)
        hashes = {}
        for i, text in enumerate(texts):
            want = re.findall(pattern, (text or "").encode().lower())
            own = words.hash[words.off[i] : words.off[i + 1]].tolist()
            assert len(own) == len(want)
            for w, h in zip(want, own, strict=True):
                assert hashes.setdefault(w, h) == h
        assert len(set(hashes.values())) == len(hashes)


def test_pieces_hold_all_rows():
    batch = pa.record_batch([pa.array(["a" * n for n in (5, 0, 9, 30, 1, 1)] + [None])], ["text"])
    parts = list(t.pieces([batch], "text", 10))
    assert [p.num_rows for p in parts] == [2, 1, 1, 3]
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()


def test_window_hash_equals_span_hash():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    at = np.arange(7)
    got = t.window_hash(data, 3)
    assert got[0] == got[3] and got[0] != got[6]
    assert len(np.unique(got)) == len(np.unique(t.span_hash(data, at, at + 3)))


def test_ids_are_those_of_the_tokenizer():
    encoder = Encoder(*default_files())
    rng = random.Random(1)
    pieces = ["word", " ", "  ", "\n", " \n", "\t", "don't", "'s", "é", "漢字", "12", "...", "<|endoftext|>", " ", "\x1f", "  ", "x ", "ſ", "Ⅷ"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(1500)] + ["", " ", None, " a", "a ", "a\n", "\n a  b"]
    got = encoder(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == encoder.whole.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_only_the_first_piece_is_short():
    assert [(p.number, p.start, len(p.ids)) for p in cut(np.arange(10), 4)] == [(0, 0, 2), (1, 2, 4), (2, 6, 4)]
    assert [(p.start, len(p.ids)) for p in cut(np.arange(8), 4)] == [(0, 4), (4, 4)]
    assert [(p.start, len(p.ids)) for p in cut(np.arange(3), 4)] == [(0, 3)]
