import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitroll.llm import pii as P
from tests.llm.edge import docs_frame, empty_docs, save

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(k, m):
    digits = re.sub("[^0-9]", "", m[0])
    return (k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split("."))
            or k == 2 and 13 <= len(digits) <= 19 and luhn(digits) or k == 3 and 9 <= len(digits) <= 15)


def brute(text):
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if holds(k, m)]


BITS = ["a@b", ".c", "@", "x.y", "1.2.3.4", "300.1.1.1", ".", "0", "4111 1111 1111 1111", "-", " ", "+1 (017) 555-7713",
        "+", "5", "é", "🙂", "00.01.1.1", "(", "4736962573099581", "one two", " dot ", " at ", "[at]", "four ", "＠", "1"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=14).map("".join))
def test_base_spans_are_those_of_the_plain_patterns(text):
    base, added = P.find(text)
    assert base == brute(text)
    for k, a, b in added:
        assert 0 <= a < b <= len(text) and not any(x[0] == k and x[1] <= a and b <= x[2] for x in base)


DISGUISED = {
    "mail john.doe [at] example [dot] com now": ("email", "john.doe [at] example [dot] com"),
    "john dot doe at mail dot example dot com, please": ("email", "john dot doe at mail dot example dot com"),
    "Jean: jean(arobase)exemple(point)fr.": ("email", "jean(arobase)exemple(point)fr"),
    "write jоhn@exаmple.com today": ("email", "jоhn@exаmple.com"),
    "john@example(dot)com": ("email", "john@example(dot)com"),
    "user[@]example[.]com": ("email", "user[@]example[.]com"),
    "ｊｏｈｎ＠ｅｘ.ｃｏｍ": ("email", "ｊｏｈｎ＠ｅｘ.ｃｏｍ"),
    "jo​hn@exa\xadmple.com x": ("email", "jo​hn@exa\xadmple.com"),
    "j&#64;b&#x2e;com": ("email", "j&#64;b&#x2e;com"),
    "ip 192 dot 168 dot one dot 10 end": ("ip", "192 dot 168 dot one dot 10"),
    "at 10[.]0[.]0[.]1!": ("ip", "10[.]0[.]0[.]1"),
    "four one one one 1111 1111 1111 it is": ("card", "four one one one 1111 1111 1111"),
    "vier eins eins eins-1111-1111-1111": ("card", "vier eins eins eins-1111-1111-1111"),
    "٤١١١ 1111 1111 1111": ("card", "٤١١١ 1111 1111 1111"),
    "call plus one five five five double seven one two three four": ("phone", "plus one five five five double seven one two three four"),
    "+1–017–555–7713": ("phone", "+1–017–555–7713"),
    "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace") + " +1 (017) five five five 7713": ("phone", "+1 (017) five five five 7713"),
}


@pytest.mark.parametrize("text", DISGUISED)
def test_disguised_data_is_found_in_its_place(text):
    base, added = P.find(text)
    assert (P.KINDS[added[0][0]], text[added[0][1]:added[0][2]]) == DISGUISED[text] and len(added) == 1


@pytest.mark.parametrize("text", [
    "We meet at noon at the dot. One of the three, five at most.", "un point de vue, punkt eins",
    "plain john.doe@example.com and +1 (017) 555-7713 or 10.0.0.1", "a@b.com point final dot x",
    "john at example.com", "John, at example dot com", "Straße 12 – 14, 3·5 and Ελλάδα, Москва"])
def test_plain_text_gets_no_further_span(text):
    assert P.find(text) == (brute(text), [])


def test_random_disguises_come_back_exactly():
    rng = random.Random(12)
    ats = [" [at] ", "(at)", " at ", "＠", "&#64;", " AT "]
    dots = [" [dot] ", "(dot)", " dot ", " DOT "]
    for _ in range(500):
        name, host = "".join(rng.choices("abcdexyz", k=5)), "".join(rng.choices("mnrstu", k=4))
        secret = f"{name}{rng.choice(ats)}{host}{rng.choice(dots)}org"
        lead = rng.choice(["", "é 🙂 ", "​now, ", "Text. "])
        text = f"{lead}{secret}, and more. {rng.choice(['', 'one two three'])}"
        assert P.find(text)[1] == [(0, len(lead), len(lead) + len(secret))], text


def test_long_hostile_texts_take_linear_time():
    units = ["a", "@", "a@", "1", "1.", "+1 ", " ", "a dot ", "a at ", "one ", "[", "​", "a at b dot c ",
             "1 dot ", "a%40", "a@b.c ", "a-at-a-dot-b ", "&#", "&", "٤"]
    for unit in units:
        text, began = unit * (400_000 // len(unit)), time.process_time()
        base, added = P.find(text)
        assert time.process_time() - began < 8, unit
        assert all(0 <= a < b <= len(text) for _, a, b in base + added)


def test_query(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", *DISGUISED, "4111 1111 1111 1111 " * 3000]
    texts += ["".join(rng.choice(BITS) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    texts += texts[2:5]
    rows = P.op12_pii(spark, save(docs_frame(spark, texts), tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        base, added = P.find(texts[r.doc_id] or "")
        assert base == brute(texts[r.doc_id] or "")
        say = lambda spans: ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(say(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in range(4))
        assert r.spans == say(base + added)


def test_empty_table(spark, tmp_path):
    assert P.op12_pii(spark, save(empty_docs(spark), tmp_path)).collect() == []
