"""Golden rows for the HTML parse pass and the Markdown converter."""

from webkb.functions.html import html_to_markdown_text, parse_page

BASE = "https://h.example.org/en/a/p.html?x=1#top"

RESOLVED = [
    ("direct.pdf", "https://h.example.org/en/a/direct.pdf"),
    ("path/file.pdf", "https://h.example.org/en/a/path/file.pdf"),
    ("file.pdf?parameter=value", "https://h.example.org/en/a/file.pdf?parameter=value"),
    ("file.pdf#section", "https://h.example.org/en/a/file.pdf#section"),
    ("/r.pdf", "https://h.example.org/r.pdf"),
    ("//cdn.example.net/z.pdf", "https://cdn.example.net/z.pdf"),
    ("../up.pdf", "https://h.example.org/en/up.pdf"),
    ("../../../x.pdf", "https://h.example.org/x.pdf"),
    ("?q=a.pdf", "https://h.example.org/en/a/p.html?q=a.pdf"),
    ("page?f=a.pdf", "https://h.example.org/en/a/page?f=a.pdf"),
    ("#a.pdf", "https://h.example.org/en/a/p.html?x=1#a.pdf"),
    (" sp.pdf", "https://h.example.org/en/a/sp.pdf"),
    ("x.pdf ", "https://h.example.org/en/a/x.pdf "),
    ("tab\t.pdf", "https://h.example.org/en/a/tab.pdf"),
    ("A.PDF", "https://h.example.org/en/a/A.PDF"),
    ("x.PDF?y=.pdf", "https://h.example.org/en/a/x.PDF?y=.pdf"),
    ("foo.pdfx/page", "https://h.example.org/en/a/foo.pdfx/page"),
    ("http://o.example.com/a.pdf", "http://o.example.com/a.pdf"),
    ("mailto:a@b", "mailto:a@b"),
    ("data:image/png;base64,AA==", "data:image/png;base64,AA=="),
    ("", "https://h.example.org/en/a/p.html?x=1#top"),
]


def test_resolution_golden():
    html = "".join(f'<a href="{h}">x</a>' for h, _ in RESOLVED)
    items = parse_page(BASE, html)
    assert [i["abs_url"] for i in items] == [r for _, r in RESOLVED]
    assert [i["pos"] for i in items] == list(range(len(RESOLVED)))


def test_comment_script_and_images():
    html = ("<!-- <a href=\"/c.pdf\"> --><script>var t=\"<a href='/s.pdf'></p>\";</script>"
            "<IMG SRC=/i.png><img src=\"\"><img alt=x><a href='/q.pdf'>")
    items = parse_page("https://h.example.org/", html)
    links = [i["value"] for i in items if i["kind"] == "a"]
    imgs = [i["value"] for i in items if i["kind"] == "img"]
    assert links == ["/q.pdf"]
    assert imgs == ["/i.png", "", None]


def test_attribute_entities():
    items = parse_page("https://h/", '<a href="/x?page=2&ref=x&amp;y=1&copy=2">a</a>')
    assert items[0]["value"] == "/x?page=2&ref=x&y=1©=2"


def test_base_and_nofollow():
    html = '<base href="https://other.example/dir/"><a href=" rel/x " rel="nofollow noopener">a</a><img src="i.png">'
    items = parse_page("https://h.example.org/p", html)
    a, img = items
    assert a["link_url"] == "https://other.example/dir/rel/x"  # stripped, joined with <base>
    assert a["abs_url"] == "https://h.example.org/rel/x "  # page URL, as PDFs and images are joined
    assert a["nofollow"] is True
    assert img["abs_url"] == "https://h.example.org/i.png"


def test_markdown_contract():
    html = ("<html><head><title>T</title><style>p{}</style></head><body><header>HEAD</header>"
            "<nav><ul><li><a href='/a'>A</a></li><li>B</li></ul></nav>"
            "<article><h1>Title</h1><p><b>bold<br><p>next <i>it</i> <code>c</code></p>"
            "<ol><li>one</li><li>two</li></ol><img src='/i.png' alt='pic'>"
            "<table><tr><th>h1</th><th>h2</th></tr><tr><td>a</td><td>b|c</td></tr></table>"
            "<pre>x  = 1\n y</pre><script>var t='</p>'</script><!-- note --></article>"
            "<footer>&copy; FOOT</footer></body></html>")
    md = html_to_markdown_text(html, "https://h.example.org/p/q")
    assert "HEAD" not in md and "FOOT" not in md and "pic" not in md and "var t" not in md and "note" not in md
    assert "- [A](https://h.example.org/a)" in md
    assert "# Title" in md
    assert "**bold**" in md and "*it*" in md and "`c`" in md
    assert "1. one" in md and "2. two" in md
    assert "| h1 | h2 |" in md and "| a | b\\|c |" in md
    assert "```\nx  = 1\n y\n```" in md
    assert "\n\n\n" not in md


def test_markdown_keeps_images_when_asked():
    md = html_to_markdown_text("<p><img src='/i.png' alt='pic'></p>", "https://h/", retain_images=True)
    assert md == "![pic](https://h/i.png)"


def test_markdown_remove_selectors():
    html = "<div class='ad'>AD</div><div id='x'>X</div><section>S</section>"
    md = html_to_markdown_text(html, "https://h/", remove=(".ad", "#x"))
    assert md == "S"


def test_omitted_end_tags_keep_the_body():
    page = "<html><head><title>x</title><meta a=b><script>var s='<h1>no</h1>'</script><body><h1>Hi</h1><p>there"
    assert html_to_markdown_text(page, "https://h/") == "# Hi\n\nthere"
    assert html_to_markdown_text("<html><head><title>x</title><h1>Hi</h1>", "https://h/") == "# Hi"
    kept = html_to_markdown_text("<ul><li>a<li class=ad>drop<ul><li>in</ul><li>c</ul>d", "https://h/", remove=("li.ad",))
    assert "drop" not in kept and "in" not in kept and "- a" in kept and "- c" in kept and kept.endswith("d")
    assert html_to_markdown_text("<div><p class=ad>drop</div>kept", "https://h/", remove=(".ad",)) == "kept"


def test_failures_have_reasons():
    from webkb.functions.html import convert_page, scan_page

    assert scan_page("https://h/", None) == ([], "html is null")
    assert convert_page(None) == (None, "html is null")
    items, error = scan_page("https://h/", '<a href="http://[x.pdf">a</a><a href="/ok.pdf">b</a>')
    assert error is None and [i["abs_url"] for i in items] == [None, "https://h/ok.pdf"]
    items, error = scan_page("https://h/", '<base href="http://["><a href="/ok.pdf">b</a>')
    assert error is None and items[0]["link_url"] == "https://h/ok.pdf"
