"""Main text of pages whose layout wrappers have names of furniture, and of pages without landmarks."""

import pytest

from tokenloom.llm.lineblocks import main_text

LONG = "A sentence of the article that goes on for quite some while, as sentences do, and then ends."


@pytest.mark.parametrize("wrapper", [
    "div class='page has-sidebar'", "div class=no-sidebar", "div class='share-enabled'", "div class='comment-page'", "div id=withSidebar",
    "form id=aspnetForm", "div class='layout sidebar-layout'", "div class=modal-page"])
@pytest.mark.parametrize("inside", ["<article><p>{0}</article>", "<main><p>{0}</main>", "<div><p>{0}</div>"])
def test_wrappers_of_a_page(wrapper, inside):
    end = wrapper.split()[0]
    page = f"<{wrapper}><nav>Home</nav>{inside.format(LONG)}<aside>{LONG}</aside><div class=comments>{LONG[:70]}</div></{end}><p>Imprint</p>"
    assert main_text(page) == LONG


def test_furniture_stays_furniture():
    cards = f"<div class=related><article>{LONG}</article><article>{LONG}</article></div>"
    replies = "<div id=comments>" + 9 * f"<article class=comment><p>{LONG}</article>" + "</div>"
    assert main_text(f"<div><p>{LONG} x</div>{cards}") == f"{LONG} x"
    assert main_text(f"<div><p>{LONG} x</div>{replies}") == f"{LONG} x"
    assert main_text(f"<article><p>x</article>{cards}{replies}") == "x"
    assert main_text(f"<div class=is-hidden>{LONG}</div><p>x") == "x"


@pytest.mark.parametrize("page, text", [
    ("<div><p>{0}</p><div class=ad>x</div><p>The end.</p></div>", "{0}\nThe end."),
    ("<div><h2>Title</h2><div class=ad>x</div><p>{0}</p><div class=ad>x</div>The end.</div>", "Title\n{0}\nThe end."),
    ("<div><section><p>{0}</section><div class=ad>x</div><section><h3>So</h3><ul><li>The end.</ul></section></div>", "{0}\nSo\nThe end."),
    ("<div><div>{0}</div><div class=ad>x</div><div>The end.</div></div>", "{0}\nThe end."),
    ("<body><p>{0}<nav>x</nav><p>The end.</body>", "{0}\nThe end."),
    ("<div id=page><div><p>Tagline</div><nav>x</nav><div><p>{0}</div><nav>x</nav><div><p>Imprint</div></div>", "{0}"),
])
def test_furniture_inside_an_article(page, text):
    assert main_text(page.format(LONG)) == text.format(LONG)
