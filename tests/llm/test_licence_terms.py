"""Values of licence expressions against all alternatives multiplied out."""

import itertools
import random

import pytest

from varloom.llm import licenses

NAMES = ["MIT", "Apache-2.0", "GPL-2.0-only", "MPL-2.0", "ISC", "Hello"]


def made(rng, depth):
    """An expression as text and as its alternatives."""
    if depth == 0 or rng.random() < 0.2:
        name = rng.choice(NAMES)
        if rng.random() < 0.15:
            return f"{name} WITH LLVM-exception", {frozenset({f"{name.lower()}-with-llvm-exception"})}
        return name, {frozenset({name.lower()})}
    (a, x), (b, y) = made(rng, depth - 1), made(rng, depth - 1)
    if rng.random() < 0.5:
        return f"({a}) OR ({b})", x | y
    return f"({a}) AND ({b})", {p | q for p, q in itertools.product(x, y)}


def sure(name):
    return not name.startswith("hello")


def free(name):
    return sure(name) and name.split("-with-")[0] in licenses.PERMISSIVE


def test_random_expressions():
    rng = random.Random(5)
    seen = 0
    for _ in range(3000):
        text, ways = made(rng, rng.randrange(5))
        value = licenses.terms(text)
        names = {n for w in ways for n in w if sure(n)}
        if not names:
            assert value is None
            continue
        seen += 1
        assert value.licences == names
        assert value.required == {n for n in frozenset.intersection(*ways) if sure(n)}
        assert value.permissive == any(all(map(free, w)) for w in ways)
        again = licenses.terms(licenses.conditions(value).replace("-with-", " with "))
        assert (again.licences, again.required, again.permissive) == (value.licences, value.required, value.permissive)
        assert licenses.conditions(again) == licenses.conditions(value)
    assert seen > 2000


@pytest.mark.parametrize(
    "text, labels, required, conditions, permissive",
    [
        ("MIT AND Apache-2.0", "apache-2.0,mit", "apache-2.0,mit", "apache-2.0 and mit", True),
        ("MIT OR Apache-2.0", "apache-2.0,mit", "", "apache-2.0 or mit", True),
        ("MIT OR GPL-3.0-only", "gpl-3.0-only,mit", "", "gpl-3.0-only or mit", True),
        ("MIT AND GPL-3.0-only", "gpl-3.0-only,mit", "gpl-3.0-only,mit", "gpl-3.0-only and mit", False),
        ("(MIT OR ISC) AND (MIT OR Zlib)", "isc,mit,zlib", "", "(mit or zlib) and (isc or mit)", True),
        ("GPL-2.0+ WITH Classpath-exception-2.0.", "gpl-2.0+-with-classpath-exception-2.0", "gpl-2.0+-with-classpath-exception-2.0", "gpl-2.0+-with-classpath-exception-2.0", False),
        ("MIT. All of it", "mit", "mit", "mit", True),
        ("hello world", "", "", "", None),
        ("MIT WITH (ISC)", "mit-with-isc", "", "", None),
        ("(MIT OR", "", "", "", None),
    ],
)
def test_rows(text, labels, required, conditions, permissive):
    row = dict(zip(licenses.COLUMNS, licenses.scan_text(f"SPDX-License-Identifier: {text}\nrest")))
    if permissive is None:
        assert row["labels"] == row["required"] == row["conditions"] == "" and row["permissive"] is None
    else:
        assert (row["labels"], row["required"], row["conditions"], row["permissive"]) == (labels, required, conditions, permissive)


def test_tags_of_one_text_hold_together():
    row = dict(zip(licenses.COLUMNS, licenses.scan_text("// SPDX-License-Identifier: MIT OR ISC\n# license-expression: GPL-3.0-only\nSPDX-License-Identifier: nothing here")))
    assert row["conditions"] == "gpl-3.0-only and (isc or mit)" and row["required"] == "gpl-3.0-only" and row["permissive"] is False


def test_long_and_deep_expressions():
    many = " OR ".join(f"LicenseRef-{i}" for i in range(60_000))
    value = licenses.terms(many)
    assert len(value.licences) == 60_000 and not value.required and licenses.conditions(value).count(" or ") == 59_999
    text = "MIT"
    for i in range(4000):
        text = f"({text}) {('AND', 'OR')[i % 2]} LicenseRef-{i}"
    value = licenses.terms(text)
    assert len(value.licences) == 4001 and value.required == set() and licenses.conditions(value).count("(") == 3999
    product = " AND ".join(f"(MIT OR LicenseRef-{i})" for i in range(200))  # 2 to the power of 200 alternatives
    assert licenses.terms(product).required == set() and licenses.terms(product).permissive
