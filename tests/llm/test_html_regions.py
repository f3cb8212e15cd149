"""Which regions of a page are its article, and the smoothing behind it."""

import numpy as np
import pytest

from emberline.llm import html as H

SHORT = ["It rained.", "We went home.", "Nobody spoke.", "The road was long.", "Dogs barked.", "Then night came."]
LONG = "A very long paragraph that somebody wrote below the text, with much more to say than the text itself had, line after line. " * 4
ARTICLE = "<article>" + "".join(f"<p>{s}</p>" for s in SHORT) + "</article>"
MENU = "".join(f"<li><a href='/{i}'>Page number {i}</a></li>" for i in range(12))


@pytest.mark.parametrize("comments", [
    f"<section id='comments'><p>{LONG}</p><p>{LONG}</p></section>", f"<div class='user-comments'><p>{LONG}</p><p>{LONG}</p></div>",
    f"<aside><p>{LONG}</p></aside>", f"<div role='search'><p>{LONG}</p></div>"])
def test_comments_are_no_article_however_long(comments):
    want = "\n".join(SHORT)
    assert H.main_text(f"<html><body>{ARTICLE}{comments}</body></html>") == want
    assert H.main_text(f"<html><body>{comments}{ARTICLE}</body></html>") == want
    inside = ARTICLE.replace("</article>", comments + "</article>")
    assert H.main_text(f"<html><body>{inside}</body></html>") == want


@pytest.mark.parametrize("menu", ["<nav><ul>" + MENU + "</ul>", "<nav>" + MENU, "<header><h1>Site</h1>", "<aside><p>Note", "<form><p>Name",
                                  "<nav><ul>" + MENU + "</ul><header>"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_unclosed_menu_ends_at_the_article(menu, tag):
    page = f"<html><body>{menu}<{tag}><p>{LONG}</p><p>The end.</p></{tag}></body></html>"
    assert H.main_text(page) == " ".join(LONG.split()) + "\nThe end."


def test_an_article_in_a_closed_menu_is_none():
    card = "<article><p>" + LONG + "</p></article>"
    assert H.main_text(f"<body><aside>{card}</aside>{ARTICLE}</body>") == "\n".join(SHORT)
    assert H.main_text(f"<body><nav>{card}</nav></body>") == ""
    assert H.main_text(f"<body><template>{card}</template><noscript>{card}</noscript></body>") == ""


@pytest.mark.parametrize("page", [
    "<body><div class='cookie-notice'><p>We use cookies to make this site better for you.</p><button>Fine</button></div></body>",
    "<body><ul>" + MENU + "</ul></body>", "<body><div>" + MENU + "</div></body>", "<body><nav>" + MENU + "</body>", "<p></p>", "", "<script>x</script>"])
def test_pages_without_an_article_are_empty(page):
    assert H.main_text(page) == ""


def test_content_without_article_elements():
    assert H.main_text(f"<body><div><p>{LONG}</p><p>Short.</p></div><div class='comments'><p>{LONG}</p></div></body>") == " ".join(LONG.split()) + "\nShort."
    assert H.main_text(f"<body><div class='sponsored'><p>{LONG}</p></div></body>") == " ".join(LONG.split())
    assert H.main_text("just a text without any tag") == "just a text without any tag"


def smooth_by_hand(x):
    weight = {k: np.exp(-k * k / 2) for k in range(-2, 3)}
    total = sum(weight.values())
    return [sum(w / total * x[min(max(i + k, 0), len(x) - 1)] for k, w in weight.items()) for i in range(len(x))]


def test_smoothing_and_threshold_by_hand():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17):
        x = rng.random(n) * 40
        assert np.allclose(H.smooth(x), smooth_by_hand(x.tolist()))
    for _ in range(200):
        n = rng.integers(1, 12)
        level, regions = rng.random(n) * 40, tuple(rng.integers(0, 4, n).tolist())
        named = set(rng.integers(0, 4, rng.integers(0, 3)).tolist())
        peak = {r: max(x for x, q in zip(level, regions) if q == r) for r in regions}
        best = max((p for r, p in peak.items() if r not in named), default=0)
        alone = all(r in named for r in regions)
        stays = {r: r not in named or alone or 0.1 * p >= best for r, p in peak.items()}
        final = {r: (p if r not in named else 0.1 * p) if stays[r] else 0.0 for r, p in peak.items()}
        values = [(x if r not in named else 0.1 * x) if stays[r] else 0.0 for x, r in zip(level, regions)]
        spread = (sum((v - sum(values) / n) ** 2 for v in values) / n) ** 0.5
        want = {r for r, p in final.items() if p > 0 and p >= min(spread, max(final.values()))} if not alone or max(final.values()) >= 2.4 else set()
        assert H.content(level, regions, named, False) == want
