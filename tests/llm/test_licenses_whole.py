import random
import re
from re import _constants as sre
from re import _parser

import pytest

from hourgrid.llm import licenses
from hourgrid.llm.license_rules import rules

PATTERNS = [re.compile(r.pattern.replace("(?i)", "(?ia)", 1)) for r in rules()]
REPEATS = (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT)


def sample(parsed, rng):
    """A text that the pattern is likely to match; look-arounds are left out."""
    out = ""
    for op, arg in parsed:
        if op is sre.LITERAL:
            out += chr(arg)
        elif op is sre.IN:
            kind, value = rng.choice(arg)
            out += {sre.CATEGORY_SPACE: " ", sre.CATEGORY_DIGIT: "7", sre.CATEGORY_WORD: "w", sre.CATEGORY_NOT_SPACE: "x"}[value] if kind is sre.CATEGORY else (
                chr(rng.randint(*value)) if kind is sre.RANGE else chr(value))
        elif op is sre.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        elif op is sre.SUBPATTERN:
            out += sample(arg[3], rng)
        elif op in REPEATS:
            low, high, part = arg
            out += "".join(sample(part, rng) for _ in range(rng.randint(low, min(high, low + 1))))
        else:
            assert op is sre.ASSERT_NOT, op
    return out


@pytest.fixture(scope="module")
def matched():
    """For every rule texts that it matches."""
    rng, out = random.Random(3), []
    for rule, pattern in zip(rules(), PATTERNS):
        parsed = list(_parser.parse(pattern.pattern))
        texts = [t for _ in range(60) if pattern.search(t := rng.choice((str.upper, str.lower, str))(sample(parsed, rng)))]
        assert texts, rule
        out.append((rule, texts))
    return out


def test_a_text_passed_over_matches_no_rule(matched):
    keywords = {r.keyword for r in rules()}
    for rule, texts in matched:
        for text in texts:
            assert rule.keyword in text.lower(), (rule, text)
            assert any(k in text.lower() for k in keywords)


def test_every_rule_counts_without_other_words(table, matched):
    """The scan finds what the patterns find, also in texts that hold nothing but a short form or an address."""
    sample_texts = [f"é {t} 😀" for _, texts in matched for t in texts[:2]]
    for r in licenses.scan_licences(table([(i, t, "s") for i, t in enumerate(sample_texts)])).collect():
        text = sample_texts[r.doc_id]
        found = [(m.start(), m.end(), rule.priority, i, rule.label) for i, (rule, p) in enumerate(zip(rules(), PATTERNS)) for m in p.finditer(text)]
        kept = [d for d in found if not any(
            e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or (e[2] == d[2] and (e[:2] != d[:2] or e[3] < d[3]))) for e in found)]
        assert kept and sorted((d["start"], d["end"], d["label"]) for d in r.detections) == sorted((d[0], d[1], d[4]) for d in kept), text


ALONE = [
    ("This work is CC BY-NC-SA 4.0.", "cc-by-nc-sa-4.0"), ("GPLv3", "gpl-3.0"), ("MPL 2.0", "mpl-2.0"), ("BSD-3-Clause", "bsd-3-clause"),
    ("MIT No Attribution", "mit-0"), ("CC0", "cc0-1.0"), ("WTFPL", "wtfpl"), ("OpenRAIL", "openrail"), ("mozilla.org/MPL/2.0", "mpl-2.0"),
    ("eclipse.org/legal/epl-v10", "epl-1.0"), ("cdla.dev/permissive", "cdla-permissive-2.0"), ("wtfpl.net", "wtfpl"),
    ("gnu.org/copyleft/gpl", "gpl"), ("ASL 2.0", "apache-2.0"), ("Apache-2", "apache-2.0"), ("licensed under ASL 2", "apache-2.0"),
]


def test_short_forms_and_addresses_alone(table):
    for r in licenses.scan_licences(table([(i, text, "s") for i, (text, _) in enumerate(ALONE)])).collect():
        assert ALONE[r.doc_id][1] in r.labels and r.score > 0, ALONE[r.doc_id]
