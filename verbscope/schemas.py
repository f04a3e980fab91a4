"""Canonical schemas (explicit; no inference on the cluster)."""

from pyspark.sql import types as T

S, L, B, TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Tables as written by the pull step (ids as strings: unsigned 64-bit ids overflow bigint).
TWEETS_RAW = _st(("tweet_id", S), ("user_id", S), ("tweet_place_id", S), ("created_at", S), ("lang", S),
                 ("text_orig", S), ("mentions", S), ("referenced_tweets", S),
                 ("retweet_count", L), ("reply_count", L), ("like_count", L), ("quote_count", L))
TWEETS = _st(("tweet_id", S), ("user_id", S), ("tweet_place_id", S), ("created_at", TS), ("lang", S),
             ("text_orig", S), ("mentions", S), ("referenced_tweets", S),
             ("retweet_count", L), ("reply_count", L), ("like_count", L), ("quote_count", L))
USERS = _st(("user_id", S), ("username", S), ("user_location", S), ("created_at", TS),
            ("followers_count", L), ("following_count", L), ("tweet_count", L), ("listed_count", L))
PLACES = _st(("place_id", S), ("location_full_name", S), ("country", S))
META = _st(("resource_id", S), ("value", S))
VERBS = _st(("verb", S), ("verb_type", S), ("indicativo", S), ("ord", T.IntegerType()))

# One API response page.
PAGE = T.StructType([
    T.StructField("data", T.ArrayType(_st(
        ("id", S), ("text", S), ("author_id", S), ("lang", S), ("created_at", S),
        ("public_metrics", _st(("retweet_count", L), ("reply_count", L), ("like_count", L), ("quote_count", L))),
        ("geo", _st(("place_id", S))),
        ("entities", T.StructType([T.StructField("mentions", T.ArrayType(_st(("username", S))))])),
        ("referenced_tweets", T.ArrayType(_st(("type", S), ("id", S))))))),
    T.StructField("includes", T.StructType([
        T.StructField("users", T.ArrayType(_st(
            ("id", S), ("username", S), ("location", S), ("created_at", S),
            ("public_metrics", _st(("followers_count", L), ("following_count", L), ("tweet_count", L),
                                   ("listed_count", L)))))),
        T.StructField("places", T.ArrayType(_st(("id", S), ("full_name", S), ("country", S)))),
    ])),
    T.StructField("errors", T.ArrayType(_st(("resource_id", S), ("value", S)))),
    T.StructField("meta", _st(("next_token", S), ("result_count", L))),
])

# Rename maps from API field names to table column names.
TWEET_RENAMES = {
    "id": "tweet_id", "author_id": "user_id", "geo.place_id": "tweet_place_id", "text": "text_orig",
    "entities.mentions": "mentions",
    "public_metrics.retweet_count": "retweet_count", "public_metrics.reply_count": "reply_count",
    "public_metrics.like_count": "like_count", "public_metrics.quote_count": "quote_count",
}
USER_RENAMES = {
    "id": "user_id", "location": "user_location",
    "public_metrics.followers_count": "followers_count", "public_metrics.following_count": "following_count",
    "public_metrics.tweet_count": "tweet_count", "public_metrics.listed_count": "listed_count",
}
PLACE_RENAMES = {"id": "place_id", "full_name": "location_full_name"}
