"""Text patterns and word lists.

Patterns are written so that Java (Spark) and RE2 (DuckDB) read them alike: no lookaround,
no back references, explicit character classes.
"""

import hashlib

# Patterns the cleaning steps must agree on.
URL = r"https?://[!$-_a-z]+"
ENTITY = r"&[(amp)(gt)(lt)]+;"
NUMBER = r" \p{Nd}+ "
CAPITALIZED = r"[A-Z][a-z]+"
TAG = r"[@#]([A-Za-z]+)"
NOT_ALNUM = r"[^a-zA-Z0-9]"
ALNUM = r"[a-zA-Z0-9]+"

# The characters Python's str.split() treats as blank.
BLANKS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# Token shapes of social-media text, tried in this order at each position. The two
# emoticons are the signs of Christopher Potts's published tokenizer for such text, in its order:
# a hat, eyes, a nose, a mouth, and the same mirrored.
TOKEN_SHAPES = {
    "url": r"https?://[!$-_a-z]+",
    "emoticon": r"[<>]?[:;=8][-o*']?[)\](\[dDpP/:}{@|\\]",
    "mirrored emoticon": r"[)\](\[dDpP/:}{@|\\][-o*']?[:;=8][<>]?",
    "markup tag": r"<[^<> ]+>",
    "arrow": r"-+>|<-+",
    "handle": r"@[A-Za-z0-9_]+",
    "hashtag": r"#+[\p{L}\p{N}_][\p{L}\p{N}_'-]*[\p{L}\p{N}_]",
    "word with inner marks": r"\p{L}[\p{L}'_-]+\p{L}",
    "number with inner marks": r"[+-]?\p{Nd}+[,/.:-]\p{Nd}+[+-]?",
    "plain word": r"[\p{L}\p{N}_]+",
    "ellipsis": r"\.[ .]*\.",
    "single sign": r"[^ ]",
}
TOKEN = "|".join(TOKEN_SHAPES.values())
# The same tokens for Java's matcher, which would read a long row of dashes or hashes again from
# each of its signs: such a token is only tried where its row begins, or where a number has just
# taken the first dash. Anywhere else it would have been found, or ruled out, at the beginning.
JAVA_TOKEN = TOKEN.replace("-+>", r"(?:(?<!-)|(?<=\p{Nd}-))-+>").replace("#+[", "(?<!#)#+[")

# Contraction endings are split from tokens that start with letters, an apostrophe and a
# letter. Tokens are held one per line, so ^ and $ are token borders.
_HEAD = r"(?m)^([A-Za-z]+(?:'[A-Za-z](?:[^\n]*[^'\n])?)?)"
CONTRACTIONS = (
    _HEAD + r"('[sSmMdD])$",
    _HEAD + r"('ll|'LL|'re|'RE|'ve|'VE)$",
    _HEAD + r"(n't|N'T)$",
)

# English stop words.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them
    their theirs themselves what which who whom this that that'll these those am is are was
    were be been being have has had having do does did doing a an the and but if or because
    as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
    haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Names of the options of one experiment.
STEMMING = ("NoStem", "Stem")
WEIGHTINGS = ("Frequency", "Binary", "TFIDF")
CLASSIFIERS = ("NaiveBayes", "Logistic", "FFNN")
SPLITS = ("train", "test")
PAD = "<pad>"


def version() -> str:
    """Digest of every pattern and list above, for what is stored under them."""
    values = {k: v for k, v in globals().items() if k.isupper()}
    return hashlib.sha256(repr(sorted(values.items())).encode()).hexdigest()[:16]
