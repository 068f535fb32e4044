"""They must equal the established data for results to agree."""

# Label given to anything that cannot be classified, suffix of
# the "rest of this parent" label, and the label prefix of training lines.
UNKNOWN = "unknow"
OTHER_SUFFIX = "_other"
LABEL_PREFIX = "__label__"
ALL_MODEL = "all"

# Probabilities that mark why a document has no prediction.
PROB_BLANK_OR_ERROR = -1.0
PROB_NO_PARENT_ANSWER = -3.0
PROB_NO_CHILD_ANSWER = -4.0

# Hash of a document too short to fingerprint, the word count it
# must exceed, the ids in a part of a member list, the usual Hamming distance.
SHORT_HASH = -1
MIN_TOKENS = 5
MEMBER_PART = 50_000
NEAR_BITS = 1

# Initials of the word classes dropped before fingerprinting
# (function words, numerals, punctuation ...) and punctuation alone.
NON_TOPIC_CLASSES = "cdempqruwxyz"
PUNCTUATION_CLASS = "w"

# The Han block kept by the crawl jobs.
HAN_CLASS = r"一-鿋"

# Boilerplate phrases cut out of article bodies.
ARTICLE_BOILERPLATE = ("点击加载图片", "查看原文", "图片来源")

# Patterns of the text clean-up and their replacements, in order. Lines
# are joined first, since ``.`` does not cross a line end; paragraph ends then become
# the only line ends.
HTML_STEPS = (
    ("\n", " "),
    ("<script>.*?</script>", ""),
    ("(</p>|</br>)\n*", "\n"),
    ("<[^>]+?>", " "),
)
RULER_MARK = r"[\-#=]"
RULER = rf"({RULER_MARK}{{3,}})"
BLANK_STEPS = ((r"\s*\n\s*", "\n"), ("[ \t]+", " "))
TAG = "<.*?>"
SQUASHED = "[\n\r\t ,]+"
CATEGORY_BREAKS = "[ _-]+"
CATEGORY_BREAK = "[ _-]"

# Category spelling variant, its standard form, and the report
# suffix for "the rest of this topic".
CATEGORY_VARIANT = "其它"
CATEGORY_STANDARD = "其他"
REST_SUFFIX = "其他"

# Event type and resource type the daily jobs select.
VIEW_EVENT = "view_article"
ARTICLE_RESOURCE = 2
