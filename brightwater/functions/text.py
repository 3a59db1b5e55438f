"""String functions over document text, as Spark columns.

Java's ``\\s``, ``\\w`` and ``\\b`` are ASCII; the classes below spell out the
Unicode ones. Everything but NFKD runs in the JVM on whole texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"

TAG_PATTERN = "<[^>]+>"
# Case-blind a-z also takes the four letters that fold to ASCII ones.
EMAIL_PATTERN = (
    r"[\p{L}\p{N}_][\p{L}\p{N}_.+-]*@[\p{L}\p{N}_-]+\.[a-zA-Z\x{130}\x{131}\x{17f}\x{212a}]{2,}(?![\p{L}\p{N}_])"
)
URL_PATTERN = rf"https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}_]+"
SENTENCE_BREAK = rf"(?<=[.!?]){SPACE}+"

# Limits a transformer encoder with 512 positions implies.
ENCODER_WORDS = 393
ENCODER_CHARS = 2048
SNIPPET_CHARS = 120

# English function words left out of token lists unless the caller names others.
STOP_WORDS = (
    "a about after all also an and any are as at be been before being but by can could did do does for from had has "
    "have he her him his how i if in into is it its just me more most my no nor not of on only or other our out over "
    "own same she so some such than that the their them then there these they this those through to too under until "
    "up very was we were what when where which while who whom why will with would you your"
).split()


def normalize_nfkd(text: Column) -> Column:
    """Unicode NFKD. ASCII text, already normal, is handed back as it came.

    Spark has no such function, so Arrow batches go through Python, where a few texts at a time are strings. The
    inner function is shipped by value: executors need not have this package.
    """

    def nfkd(texts: pa.Array) -> pa.Array:
        import unicodedata

        import pyarrow as pa
        import pyarrow.compute as pc

        done = []
        for at in range(0, len(texts), 256):
            part = texts.slice(at, 256)
            if not pc.all(pc.string_is_ascii(part), min_count=0).as_py():
                part = pa.array([t if t is None else unicodedata.normalize("NFKD", t) for t in part.to_pylist()], texts.type)
            done.append(part)
        return pa.concat_arrays(done) if done else texts

    return F.arrow_udf(nfkd, "string")(text)


def strip_html(text: Column) -> Column:
    return F.regexp_replace(text, TAG_PATTERN, " ")


def redact_email(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL_PATTERN, "[EMAIL]")


def redact_url(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, "[URL]")


def normalize_ws(text: Column) -> Column:
    """Whitespace runs to one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def clean_text(
    text: Column,
    remove_emails: bool = True,
    remove_urls: bool = True,
    lowercase: bool = False,
    normalize: bool = True,
) -> Column:
    """NFKD, tags, e-mails, URLs, whitespace, lower case, in this order."""
    out = strip_html(normalize_nfkd(text) if normalize else text)
    if remove_emails:
        out = redact_email(out)
    if remove_urls:
        out = redact_url(out)
    out = normalize_ws(out)
    return F.lower(out) if lowercase else out


def head_chars(text: Column, max_chars: int | None) -> Column:
    return text if max_chars is None else F.substring(text, 1, max_chars)


def sentences(text: Column, max_chars: int | None = None) -> Column:
    """Trimmed, non-empty sentences: a break follows ``.``, ``!`` or ``?`` and whitespace.

    Whole text by default; ``max_chars=ENCODER_CHARS`` looks at the start only.
    """
    parts = F.split(head_chars(text, max_chars), SENTENCE_BREAK)
    return F.filter(F.transform(parts, normalize_ends), lambda s: s != "")


def normalize_ends(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def tokens(text: Column, stop_words: list[str] | None = STOP_WORDS, max_chars: int | None = None) -> Column:
    """Lower-case word tokens in order, repeats kept, punctuation dropped."""
    found = F.regexp_extract_all(F.lower(head_chars(text, max_chars)), F.lit(TOKEN_PATTERN), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda t: ~t.isin(*stop_words))


def words(text: Column) -> Column:
    return F.filter(F.split(normalize_ws(text), " "), lambda w: w != "")


def truncate_words(text: Column, limit: int = ENCODER_WORDS) -> Column:
    """The first words that fit an encoder, joined by single spaces."""
    return F.array_join(F.slice(words(text), 1, limit), " ")


def snippet(text: Column) -> Column:
    return F.substring(text, 1, SNIPPET_CHARS)


def softmax(logits: Column) -> Column:
    """Probabilities of an array of scores, shifted by the maximum."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x.cast("double") - top.cast("double")))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda p: p / total)
