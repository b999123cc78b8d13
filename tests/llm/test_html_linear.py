"""The page reader takes linear time on broken markup, and reads what follows."""

import time

import pytest

from spendwatch.llm.html import blocks

PARTS = ["<a ", '<a href="x ', "<a '", "<a \"' ", "<div>", "<b>", "</p>", "<p></div>", "<", "</", "<div><b>x</i>", "<a <b>", "<p><button>"]


@pytest.mark.parametrize("part", PARTS)
def test_time_grows_with_the_page(part):
    def spent(n):
        page = part * (n // len(part))
        begun = time.process_time()
        blocks(page)
        return time.process_time() - begun

    spent(1000)
    assert spent(400_000) < 30 * max(spent(40_000), 0.01)


def test_broken_tags_end_at_the_next_one():
    found = [b.text for b in blocks("<div <p>one</p><a href=\"x>y\">two</a> <b title='<'>three</b> 1 < 2 <p>four")]
    assert found == ["one", "two three 1 < 2", "four"]
