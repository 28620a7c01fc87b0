"""Web functions: links of a page, robots rules, members of an archive, bodies of messages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.links: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a" and (href := dict(attrs).get("href")):
            self.links.append(href.strip())


def links(html: str | None, base: str | None, pattern: str | None = None, same_host: bool = False, most: int = 1000) -> list[str]:
    """Absolute links in order, each once; those that match the pattern, on the base's host if asked."""
    parser = _Anchors()
    try:
        parser.feed(html or "")
    except (AssertionError, ValueError):  # a broken page: what was read so far
        pass
    out: dict[str, None] = {}
    for href in parser.links:
        try:
            url = urljoin(base or "", href).split("#")[0]
            host_ok = not same_host or urlsplit(url).hostname == urlsplit(base or "").hostname
        except ValueError:
            continue
        if url.startswith(("http://", "https://")) and host_ok and (pattern is None or re.search(pattern, url)):
            out.setdefault(url)
        if len(out) >= most:
            break
    return list(out)


def harvest(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", pattern: str | None = None, same_host: bool = False) -> DataFrame:
    """(id, pos, link): one row for each harvested link."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(i, n, x) for i, u, h in f.itertuples(index=False) for n, x in enumerate(links(h, u, pattern, same_host))]
            yield pd.DataFrame(rows, columns=[id_col, "pos", "link"])

    return pages.select(id_col, url_col, html_col).mapInPandas(run, f"{id_col} {kind}, pos int, link string")


def robots_rules(text: str, agent: str = "*") -> list[tuple[bool, str]]:
    """(allowed, pattern) rules of the agent's group, else of the group for all."""
    groups: dict[str, list[tuple[bool, str]]] = {}
    names: list[str] = []
    fresh = True
    for line in text.splitlines():
        key, _, value = line.split("#")[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            names = [*([] if fresh else names), value.lower()]
            fresh = False
            groups.setdefault(value.lower(), [])
        elif key in ("allow", "disallow"):
            fresh = True
            if value:
                for n in names:
                    groups[n].append((key == "allow", value))
        if key != "user-agent" and key:
            fresh = True
    return groups.get(agent.lower(), groups.get("*", []))


def robots_allows(rules: list[tuple[bool, str]], path: str) -> bool:
    """The longest matching pattern decides, allow before disallow; * and a final $ are wildcards."""
    best = (-1, True)
    for allowed, pattern in rules:
        ends = pattern.endswith("$")
        form = ".*".join(re.escape(p) for p in pattern.removesuffix("$").split("*")) + ("$" if ends else "")
        if re.match(form, path):
            best = max(best, (len(pattern), allowed))
    return best[1]


def robots_filter(pages: DataFrame, robots: str, *, url_col: str = "url", agent: str = "*") -> DataFrame:
    """pages with a column allowed."""
    rules = robots_rules(robots, agent)

    @F.pandas_udf("boolean")
    def allowed(urls: pd.Series) -> pd.Series:
        def one(u: str | None) -> bool | None:
            if u is None:
                return None
            parts = urlsplit(u)
            return robots_allows(rules, (parts.path or "/") + (f"?{parts.query}" if parts.query else ""))

        return urls.map(one)

    return pages.withColumn("allowed", allowed(F.col(url_col)))
