"""Word lists, thresholds and selectors that results depend on."""

# Scoring words.
COIN_WORDS = ("비트코인", "비트", "코인", "리플", "BTC", "btc")
OTHER_WORDS = ("채굴", "화폐", "가상화폐", "달러")

# A piece of text longer than this is kept whatever it says.
LONG_PIECE = 30

# The keyword counts for the score only inside these bounds (share in hundredths).
CLEAN_LENGTH_BOUNDS = (2000, 10000)
SHARE_BOUNDS = (25, 90)

# Score parts in tenths.
BASE_TENTHS = 4
TITLE_HIT_TENTHS = 1
COIN_TENTHS = 4
OTHER_TENTHS = 2
NEITHER_TENTHS = -2
RECENCY_TENTHS = {0: 0, 2: -1, 3: -2, 4: -3}
STALE_TENTHS = -4

# Anchors whose raw href starts with one of these, or contains the last, are dropped.
SKIPPED_PREFIXES = ("javascript:", "#", "-", "i")
SKIPPED_SUBSTRING = "index.html"

# Candidate block classes of the card portal, in order of preference.
CARD_CLASSES = ("nwscnt", "newscard vr", "algocore", "news-card newsitem cardcommon")

# data-hveid values of the result portal's blocks (searched, not full match).
RESULT_BLOCK_ID = r"CA|QHw|CA[0-9a-zA-Z]+|CB[0-9a-zA-Z]+"

# Search request address forms.
API_ROWS_PER_REQUEST = 100
PORTAL_SEARCH_URLS = {
    "list": "https://search.daum.net/search?w=news&nil_search=btn&DA=NTB&enc=utf8&cluster=y&cluster_page=1&q=%s",
    "result": "https://www.google.com/search?q=%s&tbm=nws&gl=ko&hl=kr",
    "card": "https://www.bing.com/news/search?q=%s",
}

# Korean particles that follow a noun.
PARTICLES = (
    "은", "는", "이", "가", "을", "를", "의", "에", "에서", "에게", "께", "으로", "로",
    "와", "과", "도", "만", "까지", "부터", "처럼", "보다", "마다", "조차", "이나", "나",
    "이며", "라도", "이라도",
)

# Characters that strip() removes from the ends of a string.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

READY_STATUS = 200
FAILED_STATUS = 500
