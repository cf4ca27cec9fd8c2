"""Words of a text, whatever its typography and layout."""

from __future__ import annotations

import html
import re
import unicodedata

#: Letters of other scripts that look like Latin ones. Fixed values.
LOOKALIKES = str.maketrans("авеёіїјкмнорстухьѕԁһԛԝɡαβεικνορτυχӏıАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abeeiijkmhopctyxbsdhqwgabeikvoptuxliabekmhopctyxijsabezhikmnoptyx")
_GONE = re.compile("[­​-‏⁠﻿̀-ͯ]")
_BROKEN = re.compile(r"(?<=\w)-[ \t]*\r?\n[ \t]*(?=\w)")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]{0,80}>")
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    """Words in lower case without accents, hyphens, apostrophes, invisible marks and markup tags; character references and
    look-alike letters resolved, words broken at a line end joined. A word is a run of letters, digits and underscores."""
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _GONE.sub("", unicodedata.normalize("NFKD", text)).translate(LOOKALIKES)
        for mark in "‐‑’":
            text = text.replace(mark, "-")
    if "-" in text:
        if "\n" in text:
            text = _BROKEN.sub("", text)
        text = text.replace("-", "")
    return _WORD.findall(text.replace("'", "").casefold())
