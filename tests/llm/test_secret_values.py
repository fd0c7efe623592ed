"""Values beside credential words that a refused value, missing digits or a fixed pattern must not hide."""

import pytest

from medalytics.llm import secretscan


@pytest.mark.parametrize(
    "text, value",
    [
        ("login password: Xk#9dP!q2Lm", "Xk#9dP!q2Lm"),
        ("passphrase=gT#kLw!pQz&rB", "gT#kLw!pQz&rB"),
        ("password=kX9mQ2$vL7!zR4w", "kX9mQ2$vL7!zR4w"),
    ],
)
def test_whole_values_are_found(text, value):
    found = [text[a:b] for kind, a, b, _ in secretscan.scan_text(text.encode()) if kind == "guess"]
    assert found == [value]


def test_values_within_a_fixed_pattern_are_not_repeated():
    assert [s[0] for s in secretscan.scan_text(b"password=kX9mQ2vL7zR4wPq8")] == ["assign"]
