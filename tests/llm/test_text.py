import pyarrow as pa
import pytest

from arbora.llm.text import few, hashed, split_words

TEXTS = [f"{'Word' * (i % 3)} é{i}  x\t\n y{i % 7}\x0b\x0c z " * (i % 9) for i in range(300)] + [None, "", " ", "a", "\u3000 b\u00a0c"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("folded", [False, True])
def test_words_are_those_of_plain_splitting(kind, folded):
    whole = pa.record_batch([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS, kind)], names=["i", "text"])
    seen = []
    for part in few([whole, whole.slice(7, 0), whole.slice(40, 33)], 900):
        words, index, sizes = split_words(part.column("text"), folded)
        texts = [(t or "").encode() for t in part.column("text").to_pylist()]
        want = [(t.lower() if folded else t).split() for t in texts]
        assert sizes.tolist() == list(map(len, want))
        each = words.to_pylist()
        assert [each[i] for i in index] == [w for x in want for w in x] and len(set(each)) == len(each) == len(hashed(words))
        seen += part.column("i").to_pylist()
        assert part.num_rows == 1 or sum(map(len, texts)) <= 900
    assert seen == [*range(len(TEXTS)), *range(40, 73)]


def test_hashes_depend_on_the_whole_word_alone():
    words = [b"", b"a", b"a\0", b"\0a", b"abcdefgh", b"abcdefg", b"abcdefghi", b"abcdefghj", b"x" * 1000, b"x" * 1001, "é".encode()] + [str(i).encode() * (i % 5 + 1) for i in range(3000)]
    words = list(dict.fromkeys(words))
    whole = hashed(pa.array(words, pa.binary()))
    assert len(set(whole.tolist())) == len(words)
    assert (hashed(pa.array(words[::-1], pa.large_binary()))[::-1] == whole).all() and (hashed(pa.array(words).slice(7, 90)) == whole[7:97]).all()
