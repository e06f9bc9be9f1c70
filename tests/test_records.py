import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import dedup, store
from tidemark.sources import feeds, records

NOW = datetime(2026, 1, 7, tzinfo=timezone.utc)
BASE = {"tweet_id": "1", "username": "u", "created_at": "2026-01-06T20:00:00+00:00", "collected_at": "2026-01-06T20:01:00Z", "text": "Buy  now https://x.co/a !", "likes": 1, "retweets": 0, "replies": 0, "mentions": [], "hashtags": ["nifty"], "source_hashtag": "nifty"}


def lines(spark, *records_):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records_)], "raw_id long, raw_line string")


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def test_clean_text(spark):
    assert one(spark, T.clean_text, "see https://a.b/c now") == "see now"
    assert one(spark, T.clean_text, " a \n 　 b\t") == "a b"
    assert one(spark, T.clean_text, "Café www.x.y　z") == "Café z"
    assert one(spark, T.clean_text, None) is None
    assert one(spark, T.clean_text, "https://only.url") == ""


def test_lang_hint(spark):
    assert [one(spark, T.lang_hint, x) for x in ("buy", "तेजी", "buy तेजी", "123", "é")] == ["en", "hi", "mixed", "en", "en"]


def test_small_parsers(spark):
    assert [one(spark, T.parse_count, x) for x in ("1.2K", "3,401", "", "2M", "x12y", "1B", None)] == [1200, 3401, 0, 2_000_000, 12, 1_000_000_000, 0]
    assert one(spark, T.strip_markup, "<p>a</p><b>b</b>") == "a b"
    assert one(spark, T.hashtags, "#B #a #A x#c") == ["a", "b", "c"]
    assert one(spark, T.mentions, "@Z @a @Z") == ["Z", "a"]
    assert one(spark, T.card_timestamp, "Aug 4, 2026 · 12:59 PM UTC") == datetime(2026, 8, 4, 12, 59)
    assert one(spark, T.rss_timestamp, "Mon, 08 Sep 2026 10:00:00 GMT") == datetime(2026, 9, 8, 10)
    assert one(spark, T.rss_timestamp, "Tue, 08 Sep 2026 15:30:00 +0530") == datetime(2026, 9, 8, 10)
    assert tuple(one(spark, T.status_link, "https://h/user_1/status/42#m")) == ("user_1", "42")
    assert one(spark, T.status_link, "https://h/about") is None
    assert [one(spark, T.reject_bucket, x) for x in ("text: bad", "mentions.0: x", ":", None)] == ["text", "mentions_0", "unknown", "unknown"]


def test_validation_in_field_order(spark):
    cases = {
        "ok": BASE, "digits": BASE | {"likes": "5", "retweets": 5.0, "replies": True}, "tweet_id": {k: v for k, v in BASE.items() if k != "tweet_id"}, "username": BASE | {"username": 7}, "created_at": BASE | {"created_at": "yesterday", "likes": -1},
        "text": BASE | {"text": None}, "blank": BASE | {"text": "  "}, "likes": BASE | {"likes": -5}, "half": BASE | {"likes": 1.5}, "big": BASE | {"retweets": 5_000_000_000}, "mentions": BASE | {"mentions": ["a", 1]}, "source_hashtag": BASE | {"source_hashtag": ""},
        "cut": '{"tweet_id": "1', "list": "[]", "null": "null",
    }
    out = records.classify(records.clean(records.parse(lines(spark, *cases.values())))).orderBy("raw_id").collect()
    got = dict(zip(cases, [r["reject_bucket"] for r in out]))
    assert got == {
        "ok": None, "digits": None, "tweet_id": "tweet_id", "username": "username", "created_at": "created_at", "text": "text", "blank": "text", "likes": "likes", "half": "likes", "big": "retweets", "mentions": "mentions_1", "source_hashtag": "source_hashtag",
        "cut": "malformed_json", "list": "malformed_json", "null": "malformed_json",
    }
    assert (out[1]["likes"], out[1]["retweets"], out[1]["replies"]) == (5, 5, 1)
    assert out[0]["text"] == "Buy now !" and out[0]["text_normalized"] == "buy now !" and out[0]["lang_hint"] == "en"


def test_lookback_before_validation(spark):
    rows = [BASE | {"tweet_id": str(h), "created_at": (NOW - timedelta(hours=h)).isoformat()} for h in (1, 5, 23, 26, 60)]
    rows += [BASE | {"created_at": None}, BASE | {"created_at": (NOW - timedelta(hours=60)).isoformat(), "text": ""}]
    cleaned = records.clean(records.parse(lines(spark, *rows)))
    count = lambda df: {r["outcome"]: r["count"] for r in df.groupBy("outcome").count().collect()}
    assert count(records.classify(cleaned, NOW, 24)) == {"valid": 3, "out_of_window": 4}
    assert count(records.classify(cleaned)) == {"valid": 5, "rejected": 2}


def test_two_tier_dedup_is_ordered(spark):
    rows = [(0, "100", "h", "same", "u"), (1, "101", "h", "same", "u"), (2, "102", "h", "other", "u"), (3, "101", "h", "new", "u"), (4, "100", "g", "same", "u"), (5, "100", "h", "same", "u")]
    df = spark.createDataFrame(rows, "o long, tweet_id string, source_hashtag string, text_normalized string, username string")
    kept = dedup.dedup_records(df, ("text_normalized", "username", "source_hashtag"), "o")
    # 101 lost by content; its second row is lost by id, though its content is new.
    assert sorted(r["o"] for r in kept.collect()) == [0, 2, 4]
    assert dedup.dedup_records(df.limit(0), ("username",), "o").count() == 0


def test_store_round_trip(spark, tmp_path):
    rows = [BASE | {"tweet_id": str(i), "source_hashtag": f"{50 + i % 2}"} for i in range(10)] + [BASE | {"likes": -1}, "broken"]
    classified = records.classify(records.clean(records.parse(lines(spark, *rows))))
    valid = classified.where("outcome = 'valid'")
    path = f"{tmp_path}/t"
    for _ in range(2):
        store.write_processed(valid, path)
        (tmp_path / "t" / ".marker").write_text("x")
    back = store.read_processed(spark, path)
    assert back.count() == 10 and {r["hashtag"] for r in back.collect()} == {"50", "51"}
    store.write_processed(valid, path)
    assert (tmp_path / "t" / ".marker").exists() and not (tmp_path / "t.bak").exists()
    assert store.backfill(spark, path, NOW, 24).count() == 10 and store.backfill(spark, f"{tmp_path}/none", NOW, 24).count() == 0
    store.write_rejects(classified, f"{tmp_path}/r")
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if p.is_dir()) == ["reject_bucket=likes", "reject_bucket=malformed_json"]
    c = store.counters(classified, dedup.dedup_records(valid, ("text_normalized", "username", "source_hashtag"), "raw_id")).first()
    assert (c["records_in"], c["records_out"], c["records_rejected"], c["records_deduped"]) == (12, 2, 2, 8)
    assert store.write_run_summary(str(tmp_path / "log"), "processing", {"n": 1}).endswith(".json")


def test_scan_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n')
    (tmp_path / "b.txt").write_text("no")
    out = records.scan_jsonl(spark, str(tmp_path))
    assert records.parse(out).count() == 2


def test_feeds(spark):
    xml = """<rss><channel><item><title>Buy #Nifty @a_b</title><pubDate>Mon, 08 Sep 2026 10:00:00 GMT</pubDate><link>https://h/user/status/1#m</link></item>
    <item><title></title><description>&lt;p&gt;from &lt;b&gt;text&lt;/b&gt;&lt;/p&gt;</description><pubDate>bad</pubDate><link>https://h/u2/status/2</link></item>
    <item><title>no link</title><link>https://h/about</link></item></channel></rss>"""
    df = spark.createDataFrame([(xml, "nifty"), ("<rss><broken", "nifty"), (None, "nifty")], "xml string, tag string")
    out = sorted(feeds.feed_posts(df, "xml", "tag", NOW).collect(), key=lambda r: r["tweet_id"])
    assert [(r["tweet_id"], r["username"], r["text"]) for r in out] == [("1", "user", "Buy #Nifty @a_b"), ("2", "u2", "from text")]
    assert out[0]["hashtags"] == ["nifty"] and out[0]["mentions"] == ["a_b"] and out[0]["collected_at"] == datetime(2026, 1, 7) and out[0]["text_normalized"] == "buy #nifty @a_b" and out[0]["created_at"] == datetime(2026, 9, 8, 10)
    assert out[1]["created_at"] == datetime(2026, 1, 7)


def test_cards(spark):
    card = """<div class="timeline-item"><a class="tweet-link" href="/who/status/77#m"></a><span class="tweet-date"><a title="Aug 4, 2026 · 12:59 PM UTC">4h</a></span>
    <div class="tweet-content">Sell <a>#Nifty</a><a>@me</a><br>now</div>
    <span class="tweet-stat"><div class="icon-container"><span class="icon-comment"></span> 3</div></span><span class="tweet-stat"><div class="icon-container"><span class="icon-heart"></span> 1.2K</div></span></div>"""
    df = spark.createDataFrame([(card, "nifty"), ("<div>junk</div>", "nifty"), (None, "nifty")], "html string, tag string")
    (r,) = feeds.card_posts(df, "html", "tag", NOW).collect()
    assert (r["tweet_id"], r["username"], r["text"], r["likes"], r["retweets"], r["replies"]) == ("77", "who", "Sell #Nifty @me now", 1200, 0, 3)


def test_api_posts(spark):
    df = spark.createDataFrame([("9", "2026-01-06 10:00:00", "u", "t", None, 2, None, ["#B", "a", "b"], ["z", "a", "z"])], "id_str string, date string, username string, rawContent string, likeCount int, retweetCount int, replyCount int, hashtags array<string>, mentions array<string>")
    r = feeds.api_posts(df, F.lit("h"), NOW).first()
    assert (r["likes"], r["retweets"], r["replies"], r["hashtags"], r["mentions"]) == (0, 2, 0, ["a", "b"], ["a", "z"])


def test_api_objects_with_nested_users(spark):
    df = spark.createDataFrame([(None, 9, "2026-01-06 10:00:00", ("u",), "See https://x.y NOW", [("b",), ("a",)])], "id_str string, id long, date string, user struct<username: string>, rawContent string, mentionedUsers array<struct<username: string>>")
    r = feeds.api_posts(df, F.lit("h"), NOW).first()
    assert (r["tweet_id"], r["username"], r["mentions"], r["hashtags"], r["likes"], r["text_normalized"]) == ("9", "u", ["a", "b"], [], 0, "see now")


def test_what_is_parsed_passes_validation(spark):
    """A parsed row, written as JSON and read as a raw record, is valid."""
    df = spark.createDataFrame([("9", "2026-01-06 10:00:00+00:00", "u", "hello")], "id_str string, date string, username string, rawContent string")
    lines = feeds.api_posts(df, F.lit("h"), NOW).select(F.to_json(F.struct(*[F.col(c) for c in feeds._COLUMNS]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}).alias("raw_line"))
    assert [r["outcome"] for r in records.classify(records.clean(records.parse(lines))).collect()] == ["valid"]


def test_collector_key(spark):
    df = spark.createDataFrame([("Buy  NOW https://x.y", "u", "h"), ("buy now", "u", "h"), ("buy now", "v", "h"), (None, "u", "h")], "t string, u string, h string")
    keys = [r[0] for r in df.select(dedup.near_duplicate_key(F.col("t"), F.col("u"), F.col("h"))).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3


def test_raw_signals_and_log_lines(spark, tmp_path):
    import json

    df = spark.createDataFrame([("a", "1"), ("b", "2")], "source_hashtag string, tweet_id string")
    for run in ("r1", "r2"):
        store.append_raw(df, f"{tmp_path}/raw", run)
    assert spark.read.json(f"{tmp_path}/raw").count() == 4
    for _ in range(2):
        store.write_signals(df, {"1 hour": df.limit(1)}, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s/signals").count() == 2 and spark.read.parquet(f"{tmp_path}/s/rollup_1_hour").count() == 1
    assert json.loads(store.log_line("done", rows=3))["rows"] == 3
