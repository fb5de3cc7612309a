"""Pages with containers that look alike."""

from __future__ import annotations

import pytest

from lamina.llm import html

LONG = "A sentence of the story, with commas, and more of it, so that it counts. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><article><h2>One</h2><p>short</p></article><article><h2>Two</h2><p>" + LONG + "</p></article></body>", "Two\n" + LONG.strip()),
        ("<body><div><p>" + LONG + "</p></div><h2>Between</h2><div><p>" + LONG + LONG + "</p></div></body>", "\n".join([LONG.strip(), "Between", (LONG * 2).strip()])),
        ("<body>" + "<article><h2>H</h2><p>x</p></article>" * 5 + "<article><h2>Last</h2><p>" + LONG + "</p></article></body>", "Last\n" + LONG.strip()),
    ],
)
def test_like_siblings(page, text):
    assert html.main_text(page) == text
