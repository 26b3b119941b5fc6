"""HTML to text by the standard library's parser: the yardstick of the native chain; script and style are dropped."""

from __future__ import annotations

from html.parser import HTMLParser

SKIP = {"script", "style"}


class _TextOnly(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIP:
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in SKIP and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def html_to_text(value: str | None) -> str | None:
    if value is None:
        return None
    p = _TextOnly()
    p.feed(value)
    p.close()
    return "".join(p.parts)
