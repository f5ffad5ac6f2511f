"""WARC derivatives keep a page's whole text and all its out-links."""

import pytest

from ledgerline.llm import warc

BEHIND = '<p>two <a href="/x">y</a></p>'


@pytest.mark.parametrize(
    "tag",
    ['<svg class="i"/>', "<svg/>", '<svg title="a>b" />', "<svg-icon>", "<svg-icon></svg-icon>", "<template-card>", "<style-guide name='a'>", "<noscript-x/>"],
)
def test_text_behind_tags_without_hidden_content(tag):
    assert warc.html_parts(f"<p>one</p>{tag}{BEHIND}") == ("one\ntwo y", ["/x"])


@pytest.mark.parametrize("hidden", ["<svg><path d='M0'/>no</svg>", "<svg class=i/>no</svg>", "<svg\nid='a'>no</svg >", "<script/>no</script x>", "<STYLE>no</style/>", "<template>no</template>"])
def test_hidden_content_stays_hidden(hidden):
    assert warc.html_parts(f"<p>one</p>{hidden}{BEHIND}") == ("one\ntwo y", ["/x"])


def test_record_of_a_page_with_icons():
    page = f"<title-bar>no</title-bar><title>T</title><p>one</p><svg class='i'/>{BEHIND}".encode()
    (_, _, meta), (_, _, text) = warc.derive("i", "http://h.example/", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page, {})
    assert text.decode().split("\n")[-2:] == ["one", "two y"]
    assert b"outlink: http://h.example/x\r\n" in meta and b"title: T\r\n" in meta
