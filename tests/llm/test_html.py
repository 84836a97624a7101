"""Main text of pages: what markup and repetition may not take from an article."""

import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from aerowx.llm import html_extract
from aerowx.llm.html_extract import extract_main_text

SCHEMA = "page_id long, url string, html string"


def texts(spark, *pages):
    rows = [(k, f"https://h.org/{k}", html) for k, html in enumerate(pages)]
    got = {r.page_id: r for r in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(r.n_chars == len(r.text) for r in got.values())
    return [got[k].text for k in range(len(pages))]


CASES = [
    # Title and lead above an inner article; a story with an embedded card.
    ("<main><h1>Title</h1><p>Lead</p><article><p>Body</p></article></main>", "Title\nLead\nBody"),
    ("<div class=post-content><p>One</p><article><p>Card</p></article><p>Two</p></div>", "One\nCard\nTwo"),
    # Names of text in a line, of paragraphs, headings and phrases.
    ('<article><p>See <a class="search-link">these words</a> here.</p></article>', "See these words here."),
    ('<article><p id="form-of-government">A</p><h2 id="discussion">B</h2><h2 id="related-work">C</h2></article>', "A\nB\nC"),
    ('<article><section class="reply-to-critics"><p>D</p></section></article>', "D"),
    # One form around a whole page.
    ('<form id="page"><nav>x</nav><article><p>E</p></article></form>', "E"),
    ("<body><form action=x><p>F one</p><p>F two</p></form></body>", "F one\nF two"),
    # Other matter still goes, by whole names.
    (
        "<article><p>G</p><div class='newsletter-signup'>x</div><section id='comments'><p>x</p></section>"
        "<ul class='share-buttons'><li>x</ul><div class='related-posts'>x</div><form><p>x</p></form></article>",
        "G",
    ),
    ("<nav>x</nav><article><p>H</p></article><form><p>Sign up</p></form><p>stray</p>", "H"),
    (None, ""),
    ("", ""),
]


@pytest.mark.parametrize("html, want", CASES)
def test_whole_texts(html, want):
    from aerowx.llm.html_extract import page_blocks

    blocks = page_blocks(html)
    top = max((level for level, _ in blocks), default=0)
    assert "\n".join(t for level, t in blocks if level or not top) == want


def test_the_host_decides_around_an_article(spark):
    rng = random.Random(2)
    stock = "Read the best stories of this week on our own pages"
    pages, want = [], []
    for k in range(8):
        lead, body = (" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(2))
        pages.append(f"<main><p>{stock}</p><p>{lead}</p><article><p>{body}</p><p>{stock}</p></article></main>")
        want.append(f"{lead}\n{body}\n{stock}")
    # Near copies of a page, and one stored twice, don't make its lead boilerplate.
    pages += [pages[0], pages[1].replace("</article>", "<p>now</p></article>")]
    want += [want[0], want[1] + "\nnow"]
    assert texts(spark, *pages) == want


def test_repeated_rows_and_odd_pages(spark):
    rows = [(1, None, "<p>a b")] * 3 + [(None, "", None), ((1 << 60) + 1, "x", "<article>" + "long " * 60_000)]
    got = extract_main_text(spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", text int")).collect()
    assert sorted((r.page_id or 0, r.text[:4], r.n_chars) for r in got) == [
        (0, "", 0), (1, "a b", 3), (1, "a b", 3), (1, "a b", 3), ((1 << 60) + 1, "long", 299_999)
    ]


def prose(rng, n):
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


@pytest.mark.parametrize("around", ["<div>{}</div><article><p>{}</p></article>", "<article><p>{1}</p><p>{0}</p></article>"])
def test_pages_with_an_article_tell_what_the_host_repeats(spark, around):
    # One page without a content element: only pages whose markup decides have its stock line too.
    rng = random.Random(4)
    stock = "Read the best stories of this week on our own pages"
    bodies = [prose(rng, 60) for _ in range(5)]
    pages = [around.format(stock, b) for b in bodies]
    own = prose(rng, 50)
    got = texts(spark, *pages, f"<div>{stock}</div><p>{own}</p>")
    inside = f"\n{stock}" if around.startswith("<article") else ""
    assert got == [b + inside for b in bodies] + [own]


def test_repeated_runs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "_FLUSH", 400)
    monkeypatch.setattr(html_extract, "_PAGES", 3)
    rng = random.Random(6)
    lines = [prose(rng, 9) for _ in range(12)]
    rows = []
    for k in range(40):
        loose = [rng.choice(lines) if rng.random() < 0.5 else prose(rng, 12) for _ in range(3)]
        body = [rng.choice(lines) if rng.random() < 0.3 else prose(rng, 30) for _ in range(2)]
        above, inner = ("".join(f"<p>{t}</p>" for t in part) for part in (loose, body))
        html = [f"<main>{above}<article>{inner}</article></main>", above + inner, f"{above}<article>{inner}</article>"][k % 3]
        rows.append((k, f"https://h{k % 2}.org/{k}", html))
    pages = spark.createDataFrame(rows, SCHEMA)
    batch = next(html_extract._parse(iter([pages.toPandas()])))
    met, free = defaultdict(set), defaultdict(set)
    for k, (runs, loose) in enumerate(html_extract._page_runs(batch, 6)):
        for run, is_free in zip(runs.tolist(), loose.tolist()):
            met[batch["host"][k], run].add((batch["high"][k], batch["low"][k]))
            if is_free:
                free[k].add(run)

    def bits(column):
        column = np.array(column, np.int64).view(np.uint64)
        return np.bitwise_or.reduce(column) ^ np.bitwise_and.reduce(column)

    varied = {key: sum(bin(int(bits(c))).count("1") for c in zip(*pages)) for key, pages in met.items()}
    want = {k: {r for r in own if varied[batch["host"][k], r] > html_extract.DIFFERENT} for k, own in free.items()}
    parsed = spark.createDataFrame(batch.assign(place=range(len(batch))).drop(columns=["page_id", "url"]))
    found = html_extract._repeated(parsed, 6).collect()
    got = {r.place: {x % (1 << 64) for x in r.repeated} for r in found}
    assert got == {k: runs for k, runs in want.items() if runs} and len(got) > 20


def test_neighbours_of_the_order():
    rng = np.random.default_rng(1)
    frames, seen = [], defaultdict(lambda: [set(), False])
    for task in range(3):
        key = rng.integers(0, 3000, 2000).astype(np.uint64) << np.uint64(27)
        page, free = np.sort(rng.integers(0, 40, 2000)), rng.random(2000) < 0.2
        frames.append(html_extract._ordered(key, free, page, 64))
        for k, p, f in zip(key.tolist(), page.tolist(), free.tolist()):
            seen[k][0].add((task, p))
            seen[k][1] |= f
    frame = pd.concat(frames).sort_values("bucket", kind="stable", ignore_index=True)
    found = pd.concat(list(html_extract._neighbours(iter([frame]))))["short"].tolist()
    assert sorted(found) == sorted(k for k, (pages, free) in seen.items() if len(pages) > 1 and free)
