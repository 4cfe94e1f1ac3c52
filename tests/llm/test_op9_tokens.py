"""Reading pages: linear in their length, and ids in an article are anchors."""

import time

import pytest

from stratus.llm import templates


def text_of(html):
    return templates.main_text(*templates.fragments(templates.parse(html)), set())[0]


@pytest.mark.parametrize("part", ["a <b c ", "<ul>", "<ul><li>x", "x <!-- y ", 'a <b "c" ', "<p>x<div>"])
def test_a_megabyte_is_read_in_a_moment(part):
    began = time.process_time()
    text_of(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 8


def test_ids_inside_an_article_are_anchors():
    page = ("<body><div id=search>find</div><article><h2 id='search'>How to search</h2><section id='related'><p>Related work</p></section>"
            "<div class='related'>more</div><div id='comments'><p>First!</p></div></article></body>")
    assert text_of(page) == "How to search Related work"
    assert text_of("<body><div id='menu'>m</div><p>own text of the page</p>") == "own text of the page"


def test_comments_that_are_never_closed_take_the_rest():
    assert text_of("<p>a<!-- b <p>c</p> d") == "a" and text_of("<p>a<!--> b <p>c") == "a"
    assert text_of("<p>a <!-- b --> c <d") == "a c <d"
