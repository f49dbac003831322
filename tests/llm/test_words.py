import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from arrears.llm.words import CHUNKS, WORDS, find_words, grams, slices

texts = st.lists(st.text(alphabet=st.sampled_from("aZ09 \t\n\x0b\x00.,-éß日🙂"), max_size=30), max_size=6)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@given(texts)
def test_words_are_those_of_the_patterns(given_texts):
    for table, pattern in ((WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (CHUNKS, r"[^\x20\x09-\x0D]+")):
        want = [re.findall(pattern, t.translate(LOW)) for t in given_texts]
        words = find_words(pa.array(given_texts, pa.string()), table)
        assert np.diff(words.first).tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        by_hash = dict(zip(words.hash.tolist(), flat, strict=True))
        assert [by_hash[h] for h in words.hash.tolist()] == flat
        assert len(set(words.hash.tolist())) == len(set(flat))


def test_grams_and_slices():
    words = find_words(pa.array(["a b c d", "b c", None]))
    assert grams(words.hash, 2)[1] == grams(words.hash, 2)[4] and len(grams(words.hash, 9)) == 0
    batch = pa.record_batch([pa.array(["x" * 10, None, "y" * 25, "", "z"])], names=["t"])
    assert [len(part) for part in slices(batch, 0, 12)] == [2, 1, 2]
    assert sum(len(part) for part in slices(batch, 0, 1)) == 5
