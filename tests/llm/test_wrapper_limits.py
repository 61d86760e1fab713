"""HTML extraction at its limits: common subsequences of any length, deep pages, and names that an article may have, too."""

import random

import pytest

from presswork.llm import wrapper

PAGE = "<html><body><article><h1>T</h1><p>Main text of it.</p>{}</article></body></html>"


def longest(x, y):
    t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            t[i + 1][j + 1] = t[i][j] + 1 if a == b and a is not None else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("bits", [1 << 27, 1])
def test_common_is_longest(monkeypatch, bits):
    monkeypatch.setattr(wrapper, "TABLE_BITS", bits)
    rng = random.Random(1)
    for _ in range(400):
        x, y = ([rng.choice([None, *"abcdef"][: rng.randint(2, 7)]) for _ in range(rng.randint(0, 14))] for _ in range(2))
        got = wrapper.common(x, y)
        assert len(got) == longest(x, y) and all(x[i] is not None and x[i] == y[j] for i, j in got)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))


def test_common_of_many_siblings_takes_little_memory():
    import tracemalloc

    rng = random.Random(2)
    x, y = ([rng.choice("abcdefgh") for _ in range(40_000)] for _ in range(2))
    tracemalloc.start()
    n = len(wrapper.common(x, y))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 20_000 and peak < 100e6


@pytest.mark.parametrize("depth", [5, 298, 299, 300, 310, 2000])
def test_noise_goes_at_any_depth(depth):
    inner = "<article><p>Body text here.</p><nav><ul><li>menu</li></ul></nav><p>After</p><div class='advert'><div>buy</div></div>Rest</article>"
    page = "<html><body>" + "<div>" * depth + inner + "</div>" * depth + "<p>last</p></body></html>"
    text = wrapper.main_text(page)
    assert "menu" not in text and "buy" not in text and "Body text here.\nAfter\nRest" in text


@pytest.mark.parametrize(
    ("inner", "kept"),
    [
        ('<div class="related-work">K text</div>', True),
        ('<section id="discussion"><h2>D</h2><p>K text</p></section>', True),
        ('<p class="social-science">K text</p>', True),
        ('<div class="menu-recipe">K text</div>', True),
        ('<div class="related-articles"><a href=x>K text</a></div>', False),
        ('<div id="comments">K text</div>', False),
        ('<div class="ad-slot-3">K text</div>', False),
        ('<div class="social"><a>K text</a></div>', False),
        ('<div class="cookie-notice">K text</div>', False),
        ('<div class="newsletter">K text</div>', False),
    ],
)
def test_an_articles_own_names(inner, kept):
    assert ("K text" in wrapper.main_text(PAGE.format(inner))) == kept
