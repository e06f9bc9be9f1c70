"""Posts out of RSS feeds, timeline cards and search-API objects, in the raw record's shape.

Each parser is a pure function over whole files or cells; malformed input gives no rows, never an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from html import unescape
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

POST = "tweet_id string, username string, created_at timestamp, collected_at timestamp, text string, text_normalized string, likes int, retweets int, replies int, mentions array<string>, hashtags array<string>, source_hashtag string"
_COLUMNS = [c.split(" ")[0] for c in POST.split(", ")]
_LINK = re.compile(r"/(?P<username>[A-Za-z0-9_]{1,15})/status/(?P<tweet_id>\d+)")
_MARKUP = re.compile(r"<[^>]+>")
_VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
# Which icon stands for which count.
ICONS = {"comment": "replies", "retweet": "retweets", "heart": "likes"}


def _plain(markup: str) -> str:
    """Text of a piece of markup: tags are blanks, white space is one blank."""
    return " ".join(unescape(_MARKUP.sub(" ", markup)).split())


def parse_feed(xml: str | None, now: datetime) -> list[dict]:
    """The items of one RSS feed. An item needs a status link and a text, its title or else its description; without a date that can be read it is of ``now``."""
    try:
        items = ElementTree.fromstring(xml or "").iterfind("./channel/item")
    except ElementTree.ParseError:
        return []
    posts = []
    for item in items:
        fields = {child.tag: child.text or "" for child in reversed(item)}
        found = _LINK.search(f"{fields.get('link', '')} {fields.get('guid', '')}")
        text = next(filter(None, (_plain(fields.get(name, "")) for name in ("title", "description"))), None)
        if found and text:
            posts.append({**found.groupdict(), "created_at": _rfc2822(fields.get("pubDate", "")) or now, "text": text})
    return posts


def _rfc2822(text: str) -> datetime | None:
    try:
        at = parsedate_to_datetime(text.strip())
    except (TypeError, ValueError):
        return None
    return at.replace(tzinfo=at.tzinfo or timezone.utc).astimezone(timezone.utc)


class _Card(HTMLParser):
    """Reads one timeline card as it goes by: what an element's classes say it is holds until that element ends."""

    PARTS = {"timeline-item": "card", "tweet-content": "text", "tweet-stat": "stat", "tweet-date": "date"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None]] = []
        self.cards = 0
        self.marked: list[str] = []
        self.links: list[str] = []
        self.time: str | None = None
        self.texts = 0
        self.words: list[str] = []
        self.stats: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        classes = given.get("class", "").split()
        part = next((self.PARTS[c] for c in classes if c in self.PARTS), None)
        inside = {p for _, p in self.open}
        self.cards += part == "card"
        self.texts += part == "text" and "text" not in inside
        if self.cards < 2:
            if part == "stat":
                self.stats.append(("", []))
            if tag == "a" and given.get("href"):
                (self.marked if "tweet-link" in classes else self.links).append(given["href"])
            if tag == "a" and "date" in inside and self.time is None:
                self.time = given.get("title")
            icon = next((c.removeprefix("icon-") for c in classes if c.startswith("icon-")), None)
            if tag == "span" and icon and "stat" in inside and not self.stats[-1][0]:
                self.stats[-1] = (icon, self.stats[-1][1])
        if tag not in _VOID:
            self.open.append((tag, part))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in reversed(range(len(self.open))):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        inside = {p for _, p in self.open}
        if self.cards < 2 and "stat" in inside:
            self.stats[-1][1].append(data.strip())
        elif self.cards < 2 and "text" in inside and self.texts == 1:
            self.words.append(data.strip())

    def post(self) -> dict | None:
        found = next(filter(None, (_LINK.match(h) for h in self.marked[:1] or self.links)), None)
        if not (found and self.time):
            return None
        counts = {ICONS[icon]: "".join(parts) for icon, parts in self.stats if icon in ICONS}
        return {**dict.fromkeys(ICONS.values()), **counts, **found.groupdict(), "time_text": self.time, "text": " ".join(" ".join(self.words).split())}


def parse_card(html: str | None) -> dict | None:
    """Id, user, time text, post text and count texts of one timeline card; None where it has no status link or no time."""
    card = _Card()
    card.feed(html or "")
    card.close()
    return card.post()


def _finished(df: DataFrame, now: datetime) -> DataFrame:
    """``df`` in the raw record's shape: tags and mentions of the text, its lower-cased form, and when it was collected."""
    named = {} if "hashtags" in df.columns else {"mentions": T.mentions(F.col("text")), "hashtags": T.hashtags(F.col("text"))}
    return df.withColumns({**named, "text_normalized": T.normalize_for_features(T.clean_text(F.col("text"))), "collected_at": F.lit(now)}).select(_COLUMNS)


def feed_posts(feeds: DataFrame, xml: str, source_hashtag: str, now: datetime) -> DataFrame:
    """Posts of a column of RSS documents read at ``now``, with the tag each was found under; counts aren't in a feed and are 0."""
    columns = "tweet_id string, username string, created_at timestamp, text string, source_hashtag string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [{**r, "source_hashtag": h} for x, h in zip(frame["xml"], frame["tag"]) for r in parse_feed(x, now)]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in columns.split(", ")])

    got = feeds.select(F.col(xml).alias("xml"), F.col(source_hashtag).alias("tag")).mapInPandas(run, columns)
    return _finished(got.withColumns({c: F.lit(0) for c in ICONS.values()}), now)


def card_posts(cards: DataFrame, html: str, source_hashtag: str, now: datetime) -> DataFrame:
    """Posts of a column of timeline cards read at ``now``; counts and times are read by column expressions. Cards without a readable time are left out."""
    columns = "tweet_id string, username string, time_text string, text string, likes string, retweets string, replies string, source_hashtag string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [{**r, "source_hashtag": h} for x, h in zip(frame["html"], frame["tag"]) if (r := parse_card(x))]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in columns.split(", ")])

    got = cards.select(F.col(html).alias("html"), F.col(source_hashtag).alias("tag")).mapInPandas(run, columns)
    counts = {c: T.parse_count(F.coalesce(c, F.lit(""))).cast("int") for c in ICONS.values()}
    return _finished(got.withColumns(counts).withColumn("created_at", T.card_timestamp(F.col("time_text"))).where("created_at IS NOT NULL"), now)


def api_posts(objects: DataFrame, source_hashtag: Column, now: datetime) -> DataFrame:
    """Posts of search-API objects (id or id_str, date, user.username, rawContent, counts, hashtags, mentionedUsers.username) read at ``now``.

    Missing counts are 0; tags are lower case without ``#``, sorted, each once; times without a zone are UTC. Fields that
    the objects lack are taken as null; mentions come from the users named, or from a plain list ``mentions``.
    """
    have = set(objects.columns)
    pick = lambda c, kind: F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    listed = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    ids = F.coalesce(pick("id_str", "string"), pick("id", "string"))
    user = F.col("user.username") if "user" in have else pick("username", "string")
    named = F.col("mentionedUsers.username") if "mentionedUsers" in have else pick("mentions", "array<string>")
    tags = F.transform(listed(pick("hashtags", "array<string>")), lambda t: F.regexp_replace(F.lower(t), "^#+", ""))
    count = lambda c: F.coalesce(pick(c, "int"), F.lit(0))
    rows = objects.select(
        ids.alias("tweet_id"), user.alias("username"), pick("date", "timestamp").alias("created_at"), pick("rawContent", "string").alias("text"), count("likeCount").alias("likes"), count("retweetCount").alias("retweets"), count("replyCount").alias("replies"),
        F.array_sort(F.array_distinct(listed(named))).alias("mentions"), F.array_sort(F.array_distinct(tags)).alias("hashtags"), source_hashtag.alias("source_hashtag"),
    )
    return _finished(rows, now)
