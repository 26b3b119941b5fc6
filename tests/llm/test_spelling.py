"""op11 against pairwise edit distances."""

import random
import re
import zlib
from collections import Counter

import pytest

from sentimart.llm import spelling

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures


def near(a, b):
    """Exactly one inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, shortest=6, least=5, ratio=5, every=199):
    counts = Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in word)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    out, forms = [], {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        top = min(around, key=lambda x: (-words[x], x), default=None)
        forms[w] = top if top is not None and words[top] >= ratio * n else None
        out.append((w, n, len(around), forms[w], words[forms[w]] if forms[w] else None))
    rooted = []
    for row in out:
        root = row[0]
        while forms[root]:
            root = forms[root]
        rooted.append((*row, root))
    return sorted(rooted)


def sample(seed):
    rng = random.Random(seed)
    syllables = ["tion", "ment", "eau", "ier", "ßa", "é", "è", "ou", "ana", "na", "aa", "x", "s", "s"]
    stems = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(60)]
    words = []
    for s in stems:
        words += [s] * rng.choice([3, 6, 40, 200])
        for _ in range(8):
            i, c = rng.randrange(len(s)), rng.choice("aenst")
            words += [rng.choice([s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :], s.upper()])] * rng.choice([1, 5, 6, 30])
    rng.shuffle(words)
    return [(i, rng.choice([" ", ", ", "1"]).join(words[i * 20 : i * 20 + 20])) for i in range(len(words) // 20)]


@pytest.mark.parametrize("frequent, every", [(spelling.FREQUENT, 199), (2, 7), (100_000, 50)])
def test_groups(docs_of, monkeypatch, frequent, every):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (frequent,))
    rows = [*sample(3), *ODD_ROWS, (70, "dolors dolors lorems"), (70, "Dolors dolors dolors DOLORS")]
    got = spelling.spelling_groups(docs_of(rows), every=every).collect()
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got) == brute(rows, every=every)


def test_chain_and_empty(docs_of):
    rows = [(i, "abcdef " * 6) for i in range(1)] + [(9, "abcdefg " * 40), (10, "abcdefgh " * 300)]
    got = {r.word: (r.form, r.root) for r in spelling.spelling_groups(docs_of(rows), every=1 << 40).collect()}
    assert got == {"abcdef": ("abcdefg", "abcdefgh"), "abcdefg": ("abcdefgh", "abcdefgh"), "abcdefgh": (None, "abcdefgh")}
    assert spelling.spelling_groups(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(docs_of([]), shortest=3)
