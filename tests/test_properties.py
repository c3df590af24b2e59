"""Property tests against brute force on small random inputs."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from windtally.functions.timewin import DAY, HOUR, WEEK
from windtally.operators.ranking import top_n
from windtally.operators.rollup import count_by, flatten, rollup

EPOCH = datetime(2018, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from("abcdefg"), st.integers(1, 300)),
    min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_strategy)
def test_top_n_matches_sort(spark, rows):
    agg = Counter()
    for w, a, n in rows:
        agg[(w, a)] += n
    data = [(EPOCH + timedelta(days=w), a, n) for (w, a), n in agg.items()]
    df = spark.createDataFrame(data, "window_start timestamp_ntz, article_id string, n bigint")
    got = sorted((r.window_start, r.rnk, r.article_id, r.n) for r in top_n(df).collect())
    want = []
    for w in sorted({d[0] for d in data}):
        items = sorted([d for d in data if d[0] == w], key=lambda d: (-d[2], d[1]))[:3]
        want += [(w, i + 1, d[1], d[2]) for i, d in enumerate(items)]
    assert got == sorted(want)


ts_strategy = st.lists(st.tuples(st.integers(0, 20 * 86400 - 1), st.sampled_from("xyz")), min_size=1, max_size=60)


@SETTINGS
@given(rows=ts_strategy)
def test_chained_counts_match_bucketing(spark, rows):
    data = [(EPOCH + timedelta(seconds=s), a) for s, a in rows]
    df = spark.createDataFrame(data, "create_ts timestamp, article_id string")
    hourly = count_by(df, HOUR, ["article_id"])
    weekly = flatten(rollup(rollup(hourly, DAY, ["article_id"]), WEEK, ["article_id"]))
    got = Counter({(r.window_start, r.article_id): r.n for r in weekly.collect()})
    want = Counter()
    for t, a in data:
        monday = datetime(t.year, t.month, t.day) - timedelta(days=t.weekday())
        want[(monday, a)] += 1
    assert got == want


# --- validity rules vs a plain-Python statement of them ----------------------
import json
import re as _re

from windtally.operators.quality import with_validity

_BASE = {"approveDate": 1514764900000, "articleId": "a", "articleWordCount": 1, "commentID": 1,
         "commentType": "c", "createDate": 1514764800000, "depth": 1, "editorsSelection": False,
         "inReplyTo": 0, "parentUserDisplayName": "", "recommendations": 3, "sectionName": "s",
         "userDisplayName": "u", "userID": 7, "userLocation": "x"}


def _python_verdict(member, text):
    """Expected verdict for one member's text (None = JSON null)."""
    if text is None:
        return member in ("userLocation",)  # string members accept null; numbers do not
    if member in ("depth", "recommendations"):
        return bool(_re.fullmatch(r"[+-]?[0-9]+", text)) and -2**31 <= int(text) < 2**31
    if member in ("userID", "commentID"):
        return bool(_re.fullmatch(r"\+?[0-9]+", text)) and int(text) <= 4294967295
    if member == "createDate":
        return bool(_re.fullmatch(r"[+-]?[0-9]+", text)) and abs(int(text)) < 9223372036854775 - 60 * 86400000
    return True


_texts = st.one_of(
    st.none(),
    st.from_regex(r"[+-]?[0-9]{1,12}", fullmatch=True),
    st.from_regex(r" ?[+-]?[0-9]{1,3}(\.[0-9])? ?", fullmatch=True),
    st.integers(-2**40, 2**40).map(str),
    st.sampled_from(["", "abc", "1e3", "0x10", "+", "-", "4294967296", "2147483648", "-2147483649",
                     "9223372036854775807", "-9223372036854775808", "99999999999999999999"]),
)


@SETTINGS
@given(cases=st.lists(st.tuples(st.sampled_from(["depth", "recommendations", "userID", "commentID",
                                                  "createDate", "userLocation"]), _texts),
                      min_size=1, max_size=25))
def test_validity_rules_match_python(spark, cases):
    docs = []
    for member, text in cases:
        d = dict(_BASE)
        d[member] = text
        docs.append((json.dumps(d),))
    df = spark.createDataFrame(docs, "value string").selectExpr("CAST(NULL AS STRING) AS key", "value")
    got = {r.value: r.is_valid for r in with_validity(df).collect()}
    for (member, text), (doc,) in zip(cases, docs):
        assert got[doc] == _python_verdict(member, text), (member, text)
