"""Written pages."""

from tickvault.llm.html_text import EXPECTED, main_text, tag_counts

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site<nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies here <button>OK</button></div><main><article><h1>A  title</h1>
<p>First <b>bold</b> text,<br>with <a href="x>y">a link</a> &amp; &copy; signs.</p><ul><li>item one</li><li>item two</li></ul>
<div class="ad banner">Buy now and save lots of money</div><p>The end of the article.</p></article>
<section id="comments"><article class="comment"><p>Nice post, I loved reading this!</p></article></section></main>
<aside><p>Other things to read, many of them</p></aside><form>Sign up <input name=a></form><footer>(c) x</footer><script>if (a<b) x="<p>no</p>"</script></body></html>"""


def test_page():
    assert main_text(PAGE, EXPECTED) == "A title\nFirst bold text, with a link & © signs.\nitem one\nitem two\nThe end of the article."


def test_edges():
    assert main_text("", EXPECTED) == ""
    assert main_text("no tags at all", EXPECTED) == "no tags at all"
    assert main_text("a < b and <p>c", EXPECTED) == "a < b and\nc"
    assert main_text("<p>x y z<!-- never closed", EXPECTED) == "x y z"
    assert main_text("<p>x y z</p><script>never closed", EXPECTED) == "x y z"
    assert main_text('<p>x y z</p><a href="never closed', EXPECTED) == "x y z"
    assert main_text("<p>&lt;b&gt; &amp;amp;</p>", EXPECTED) == "<b> &amp;"
    assert main_text('<div class="ad">never closed<article><p>one two three</p></article>', EXPECTED) == "one two three"
    assert main_text("<p>" + "word " * 50_000 + "</p>", EXPECTED).count("word") == 50_000


def test_labels_count_one_article():
    counts = tag_counts("<ul></ul><article><p>x</p></article>")
    assert counts["p", True] == 2 and counts["ul", False] == 2 and counts["article", False] == 2
    assert not tag_counts("<article></article><article></article>") and not tag_counts("<p>x</p>")
