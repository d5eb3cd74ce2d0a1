"""Destination listings in article text: sections, links with their class of service and dated changes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.functions import columns as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Words that say what a parenthesis is about.
CHANGES = ("begin", "start", "commence", "end", "resume", "suspend", "terminat", "cancel", "discontinu")
SEASON_NOTE = "seasonal"


def _headings(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, level, lower-case title) of each heading line."""
    out, at = [], 0
    for line in text.splitlines(keepends=True):
        bare = line.strip()
        level = min(len(bare) - len(bare.lstrip("=")), len(bare) - len(bare.rstrip("=")), 6)
        if level >= 2 and len(bare) > 2 * level:
            out.append((at, at + len(line), level, bare.strip("=").strip().lower()))
        at += len(line)
    return out


def sections(text: str, title: str, excluded: tuple[str, ...] = ()) -> str:
    """The body of the first heading with this title, up to a heading as high or higher, without subsections whose title holds an excluded word."""
    text = text or ""
    heads = [*_headings(text), (len(text), len(text), 0, "")]
    first = next((i for i, h in enumerate(heads[:-1]) if h[3] == title.lower()), None)
    if first is None:
        return ""
    own, skip, out = heads[first], 0, []
    for (_, end, level, name), following in zip(heads[first:], heads[first + 1 :], strict=False):
        if level <= own[2] and end != own[1]:
            break
        if skip and level <= skip:
            skip = 0
        if not skip and end != own[1] and any(word in name for word in excluded):
            skip = level
        if not skip:
            out.append(text[end : following[0]])
    return "".join(out)


def _plain(text: str) -> str:
    """The text without comments, references and templates, however deep they nest; what a list template lists stays."""
    out, at = [], 0
    dropped: list[bool] = []  # of the open templates, whether they are
    while at < len(text):
        low = text[at : at + 5].lower()
        if low.startswith("<!--"):
            end = text.find("-->", at)
            at = len(text) if end < 0 else end + 3
        elif low.startswith("<ref") and text[at + 4 : at + 5] in (">", " ", "/"):
            shut = text.find(">", at)
            end = shut if shut > 0 and text[shut - 1] == "/" else text.lower().find("</ref>", at)
            at = len(text) if end < 0 else text.find(">", end) + 1 or len(text)
        elif low.startswith("{{"):
            name = text[at + 2 : at + 80].split("|")[0].split("}")[0].lower()
            dropped.append(any(dropped) or "list" not in name)
            at += 2
        elif low.startswith("}}") and dropped:
            dropped.pop()
            at += 2
        else:
            if not any(dropped):
                out.append(text[at])
            at += 1
    return "".join(out)


def _pieces(text: str) -> Iterator[tuple[str, str]]:
    """(kind, content) of links, bold labels, parentheses and ends of cells or lines, in order; all else is passed over."""
    at = 0
    while at < len(text):
        for kind, opening, closing in (("link", "[[", "]]"), ("label", "'''", "'''"), ("note", "(", ")")):
            if text.startswith(opening, at) and (end := text.find(closing, at + len(opening))) >= 0:
                yield kind, text[at + len(opening) : end].strip()
                at = end + len(closing)
                break
        else:
            if text[at] in "|\n":
                yield "cell" if text[at] == "|" else "line", ""
            at += 1


def scan(text: str) -> Iterator[tuple[str, str, str | None]]:
    """(title, label, change) of each link. A label holds up to the end of its cell; a note is about the link before it, or both or all of them.

    A note that says seasonal is the label of its links. Comments, references and templates are left out.
    """
    label, found = "", []
    for kind, said in _pieces(_plain(text or "")):
        if kind == "link":
            if target := said.split("|")[0].split("#")[0].strip():
                found.append([target, label, None])
        elif kind == "label":
            label = said.rstrip(":")
        elif kind == "note":
            words = said.split()
            covers = {"both": 2, "all": len(found)}.get(words[0].lower() if words else "", 1)
            words = words[1:] if words and words[0].lower() in ("both", "all") else words
            plain = words[1:] if words and words[0].lower() == "temporarily" else words
            for row in found[max(0, len(found) - covers) :] if plain else []:
                if plain[0].lower().startswith(CHANGES):
                    row[2] = " ".join(words)
                elif plain[0].lower().startswith(SEASON_NOTE):
                    row[1] = " ".join(plain)
        else:
            yield from map(tuple, found)
            label, found = "" if kind == "cell" else label, []
    yield from map(tuple, found)


def listings(articles: DataFrame, title: str = "Airlines and destinations", excluded: tuple[str, ...] = ("cargo", "statistics")) -> DataFrame:
    """article, title, service, change, on of every listed link. articles: article, text."""

    def run(batches):
        for batch in batches:
            rows = [(a, t, s, c) for a, x in zip(batch["article"], batch["text"], strict=True) for t, s, c in scan(sections(x, title, tuple(e.lower() for e in excluded)))]
            yield pd.DataFrame(rows, columns=["article", "title", "label", "raw"])

    rows = articles.select("article", "text").mapInPandas(run, "article string, title string, label string, raw string")
    change = C.change_kind("raw")
    service = F.when(F.col("label") == "", "scheduled").otherwise(C.service_of("label"))
    return rows.select("article", F.replace("title", F.lit("_"), F.lit(" ")).alias("title"), service.alias("service"), change.alias("change"), F.when(change != "suspended", C.change_date("raw", F.coalesce(change == "ends", F.lit(False)))).alias("on"))
