"""op9: base spans against the plain patterns, disguises by example."""

import random
import re

import pyarrow as pa
import pytest

from sentimart.llm import pii

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("letters", ["a1.@-2 5+_é()0", "12 4.5-+0", "ab@.c_%", "0123456789 "])
def test_base_spans_equal_the_patterns(letters):
    rng = random.Random(letters)
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert [s[:3] for s in pii.spans_of(text) if s[3]] == plain(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("or john at example dot com.", "email", "john at example dot com"),
        ("jоhn@exаmple.com x", "email", "jоhn@exаmple.com"),
        ("plus four four two zero seven nine four six zero nine five eight.", "phone", "plus four four two zero seven nine four six zero nine five eight"),
        ("card ４９４４ 3394 9042 9605!", "card", "４９４４ 3394 9042 9605"),
        ("is 4944​339490429605 it", "card", "4944​339490429605"),
        ("ip 192[.]168[.]1[.]1 ok", "ip", "192[.]168[.]1[.]1"),
        ("write john     [     at     ]     example (\t dot  \t ) com now", "email", "john     [     at     ]     example (\t dot  \t ) com"),
    ],
)
def test_disguises(text, kind, found):
    assert [(k, text[a:b], base) for k, a, b, base in pii.spans_of(text)] == [(kind, found, False)]
    assert pii.masked(text, pii.spans_of(text)) == text.replace(found, f"<{kind}>")
    assert pii.spans_column(pa.array([text, None]))[0] == pii.spans_of(text)  # the column's filter lets it through


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("at one nine two dot one six eight dot zero dot one now", "ip", "one nine two dot one six eight dot zero dot one"),
        ("at 192.168.zero.one now", "ip", "192.168.zero.one"),
        ("call +4420 seven nine four six zero one now", "phone", "+4420 seven nine four six zero one"),
        ("call plus one (four one five) five five five 2671 now", "phone", "plus one (four one five) five five five 2671"),
        ("pay 4111 1111 1111 one one one one now", "card", "4111 1111 1111 one one one one"),
        ("call plus four four two zero seven nine four six zero nine five eight. one two three four more", "phone", "plus four four two zero seven nine four six zero nine five eight"),
    ],
)
def test_short_spelled_runs(text, kind, found):
    assert [(k, text[a:b], base) for k, a, b, base in pii.spans_of(text)] == [(kind, found, False)]
    assert pii.spans_column(pa.array([text]))[0] == pii.spans_of(text)


def test_ordinary_text_adds_nothing():
    for text in ("we met at noon and one by one six of them left", "un deux trois", "see (at) least; point. 5 - 6", "a@b c dot", "the dot at the end"):
        assert pii.spans_of(text) == []


def test_frames(docs_of, llm_spark):
    rows = [*ODD_ROWS, (8, "a@b.co and +1 (988) 555-2485")]
    got = pii.find_pii(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, tuple(s.kind for s in r.spans)) for r in got if r.spans} == {(8, ("email", "phone"))}
    masked = pii.mask_pii(docs_of(rows))
    assert masked.columns == docs_of(rows).columns
    assert sorted(str((r.doc_id, r.text)) for r in masked.collect()) == sorted(str((k, "<email> and <phone>" if k == 8 else t)) for k, t in rows)
    assert pii.find_pii(docs_of([])).count() == 0


def test_long_blanks_are_read_in_linear_time():
    import time

    text = "a [" + " " * 200_000 + "[ at" + " " * 200_000 + "x" + " \t" * 200_000 + "[at] b.co"
    begin = time.process_time()
    assert [text[a:b][-9:] for _, a, b, _ in pii.spans_of(text)] == ["[at] b.co"]
    assert time.process_time() - begin < 5
