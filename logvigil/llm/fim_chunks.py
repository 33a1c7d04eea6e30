"""Fill-in-middle documents: token cuts located through content-defined chunks that are measured once.

A rolling hash over 16 bytes cuts each text into chunks whose borders depend on nearby content only, so passages that
documents share become equal chunks. A chunk's summary (words that start in it, its code points, whether it begins and
ends inside a word) is remembered under the chunk's bytes: the whole content is compared, an equal hash alone is
no hit. Summaries add up from left to right, a word that runs over a border counting once; the running sums tell which
chunk holds the end of the k-th token, and only that chunk is searched. What is remembered is bounded, and a text is
hashed in blocks, so very long texts need little more than themselves.

Tokens are words with the white space before them, and the white space at the end. Two tagged numbers of the document's
id pick the cuts. The text comes back as it is (``plain``) if it is empty or holds a sentinel, or by the share asked for;
otherwise as prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``). No text with a sentinel is
cut, so ``restored`` rebuilds each text exactly from the output and its form.

Null text counts as empty: no tokens, plain. A null id counts as the empty text in the seed. Repeated rows give
repeated results. An empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import let

#: The sentinels and the seed's tag.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42

WINDOW = 16  # bytes under the rolling hash
LEAST, MOST = 256, 8192  # bytes of a chunk
BORDER = 10  # bits that are zero at a border: chunks of about 1 KB above the least
BLOCK = 1 << 20  # bytes hashed at once
REMEMBERED = 16 << 20  # bytes of chunks kept in a worker
SPACE = frozenset(b" \t\n\r\x0b\x0c")
_CONTINUED = bytes(range(0x80, 0xC0))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_TABLE = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """The hash of the ``WINDOW`` bytes from each place on, by doubling the width."""
    h, width, times = _TABLE[data], 1, np.uint32(0x9E3779B1)
    while width < WINDOW:
        h = h[:-width] * times + h[width:]
        width, times = 2 * width, times * times
    return h


def borders(data: bytes) -> list[int]:
    """Ends of the chunks, the last one the text's end."""
    n = len(data)
    if n <= LEAST:
        return [n]
    raw, found = np.frombuffer(data, np.uint8), [np.empty(0, np.int64)]
    for lo in range(0, n - WINDOW + 1, BLOCK):
        h = rolling(raw[lo:lo + BLOCK + WINDOW - 1])
        found.append(np.flatnonzero(h >> np.uint32(32 - BORDER) == 0) + (lo + WINDOW))
    marks, out, at = np.concatenate(found), [], 0
    while n - at > LEAST:
        i = np.searchsorted(marks, at + LEAST)
        end = int(marks[i]) if i < len(marks) else n
        at = min(end, at + MOST, n)
        out.append(at)
    if at < n:
        out.append(n)
    return out


@dataclass(slots=True)
class Summary:
    words: int  # that start in the chunk, a word at its very beginning among them
    chars: int
    opens: bool  # begins inside or at a word
    closes: bool  # ends inside or at a word


class Chunks(dict):
    """Summaries by content, forgotten all at once beyond ``limit`` bytes of chunks."""

    def __init__(self, limit: int = REMEMBERED):
        super().__init__()
        self.limit, self.held = limit, 0

    def __missing__(self, chunk: bytes) -> Summary:
        if self.held >= self.limit:
            self.clear()
            self.held = 0
        self.held += len(chunk) + 200
        out = self[chunk] = Summary(len(chunk.split()), code_points(chunk), chunk[0] not in SPACE, chunk[-1] not in SPACE)
        return out


def code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUED))


def _word_end(data: bytes, k: int) -> int:
    """Where the k-th word ends."""
    for i, m in enumerate(_WORD.finditer(data), 1):
        if i == k:
            return m.end()
    raise ValueError("fewer words than asked for")


class Text:
    """The chunks of one text, with the words and code points before each."""

    def __init__(self, data: bytes, known: Chunks):
        self.data, self.ends = data, borders(data) if data else []
        self.words, self.chars, self.runs = [0], [0], []
        at, inside = 0, False
        for end in self.ends:
            s = known[data[at:end]]
            run = inside and s.opens  # the word from the left goes on
            self.runs.append(run)
            self.words.append(self.words[-1] + s.words - run)
            self.chars.append(self.chars[-1] + s.chars)
            at, inside = end, s.closes
        self.tokens = self.words[-1] + (bool(data) and not inside)

    def cut(self, k: int) -> int:
        """Code points of the first ``k`` tokens."""
        if k <= 0:
            return 0
        if k >= self.tokens:
            return self.chars[-1]
        j = int(np.searchsorted(self.words, k)) - 1  # the chunk in which the k-th word starts
        start = self.ends[j - 1] if j else 0
        last = j
        while last + 1 < len(self.ends) and self.runs[last + 1] and self.words[last + 1] == k:
            last += 1  # its last word runs on; chunks without a word of their own may lie between
        data = self.data[start:self.ends[last]]
        return self.chars[j] + code_points(data[:_word_end(data, k - self.words[j] + self.runs[j])])


_KNOWN = Chunks()


def _places(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    n, lo, hi = [], [], []
    for t, a, b in zip(texts, first.to_pylist(), second.to_pylist()):
        text = Text((t.as_py() or "").encode("utf-8", "surrogatepass"), _KNOWN)
        a, b = sorted((a % (text.tokens + 1), b % (text.tokens + 1)))
        n.append(text.tokens)
        lo.append(text.cut(a))
        hi.append(text.cut(b))
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, lo, hi)], ["n", "lo", "hi"])


places = F.arrow_udf(_places, StructType([StructField(x, LongType()) for x in ("n", "lo", "hi")]))


def _after(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made from."""
    o, f = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    psm = F.concat(_before(_after(o, PREFIX), SUFFIX), _after(o, MIDDLE), _before(_after(o, SUFFIX), MIDDLE))
    spm = F.concat(_before(_after(o, PREFIX), MIDDLE), _after(o, MIDDLE), _before(_after(o, SUFFIX), PREFIX))
    return F.when(f == "psm", psm).when(f == "spm", spm).otherwise(o)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50, spm: int = 80, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: ``rate`` per cent of the texts are cut, ``spm`` per cent of them suffix first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    tag = [F.conv(F.substring("_d", 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    tagged = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"), digest.alias("_d")).select("doc_id", "_t", *[h.alias(f"_h{i}") for i, h in enumerate(tag, 1)])
    held = [F.contains(F.col("_t"), F.lit(s)) for s in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("_t") == "") | held[0] | held[1] | held[2] | (F.col("_h3") % 100 >= rate)
    cut = tagged.withColumn("_c", places("_t", "_h1", "_h2")).withColumn("form", F.when(plain, "plain").when(F.col("_h4") % 100 < spm, "spm").otherwise("psm"))
    t, lo, hi = F.col("_t"), F.col("_c.lo").cast("int"), F.col("_c.hi").cast("int")
    parts = F.struct(F.substring(t, F.lit(1), lo).alias("p"), F.substring(t, lo + 1, hi - lo).alias("m"), F.substring(t, hi + 1, F.length(t)).alias("s"))
    psm = let(parts, lambda x: F.concat(F.lit(PREFIX), x.p, F.lit(SUFFIX), x.s, F.lit(MIDDLE), x.m))
    spm_ = let(parts, lambda x: F.concat(F.lit(SUFFIX), x.s, F.lit(PREFIX), x.p, F.lit(MIDDLE), x.m))
    return cut.select(
        "doc_id", F.col("_c.n").alias("n"), "form",
        F.when(F.col("form") != "plain", F.col("_c.lo")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("_c.hi") - F.col("_c.lo")).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_).otherwise(t).alias("output"))


def report(docs: DataFrame) -> DataFrame:
    """The digests of outputs and of the texts rebuilt from them."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"))


FIM_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
h AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(pre || mid || suf) AS restored_sha256
FROM p
"""
