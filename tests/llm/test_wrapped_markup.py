"""Pages whose markup wraps the article in boilerplate names, forms or unclosed elements."""

import pytest

from ledgerlake.llm import html_mincut

PARTS = ["The river rose in the night and the bridge was closed to all carts until the morning came.",
         "Nobody had seen such water since the old mill burned, and the miller said so to everyone."]
TEXT = "\n".join(PARTS)
BODY = "".join(f"<p>{p}</p>" for p in PARTS)
NAV = "<nav><a href=/a>Home</a> <a href=/b>News</a></nav>"
COMMENTS = "<div class=comments>" + "<article class=comment><p>I do not think that this is so, and I say it often.</p></article>" * 9 + "</div>"


@pytest.mark.parametrize("wrapper", ["<div class='layout with-sidebar'>%s</div>", "<div id=no-comments>%s</div>", "<div class=header-fixed>%s</div>",
                                     "<form action=/x>%s</form>"])
@pytest.mark.parametrize("inner", ["%s", "<article>%s</article>", "<main>%s</main>"])
def test_a_wrapper_does_not_empty_the_page(wrapper, inner):
    page = "<html><body>" + wrapper % (NAV + inner % BODY + "<div class=ad>Buy now.</div><footer>(c) us</footer>") + "</body></html>"
    assert html_mincut.main_text(page) == TEXT


def test_comments_longer_than_the_article_stay_out():
    assert html_mincut.main_text(f"<body><article>{BODY}</article>{COMMENTS}</body>") == TEXT
    assert html_mincut.main_text(f"<body><div class=with-sidebar><main>{BODY}{COMMENTS}</main></div></body>") == TEXT
    assert html_mincut.main_text(f"<body><main>{BODY}</main><div hidden><article>{BODY}</article></div></body>") == TEXT


@pytest.mark.parametrize("tag", ["noscript", "select", "button", "svg"])
def test_unclosed_elements_do_not_end_the_page(tag):
    assert html_mincut.main_text(f"<body><{tag}><article>{BODY}</article></body>") == TEXT
    assert html_mincut.main_text(f"<body><article>{BODY}</article><script>var a = 1; <p>no</p>") == TEXT
