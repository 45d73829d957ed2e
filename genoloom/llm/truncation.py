"""Texts cut off by field limits or in transfer: a backward character n-gram model of where texts end.

Read backward from a position, the last characters, the word its line begins with and the bracket depth
make a context. Counted over all positions of all texts, contexts tell how often a text ends there and how
often it goes on. A text whose final context hardly ever ends complete texts, compared with how often it
occurs inside texts, was cut. Characters inside strings and comments count as such, so that brackets and
sentences in them mislead nobody. The threshold on the log-odds is set per language, and per source column
and length: far more texts of one source with the same length than with lengths near it show a field limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import Scratch

# Signs of a language, used only where the file name's language shows none of its own.
SIGNS = {
    "python": ("\ndef ", "def ", "\n    return ", "import ", "self", "\n    if "),
    "go": ("\nfunc ", "func ", " := ", "package ", ", nil"),
    "java": ("public ", "private ", "final ", "@Override", "import java"),
    "c": ("static ", "struct ", "#include", "->", "sizeof("),
    "javascript": ("function ", "function(", "const ", "=> {", "});", "let "),
    "sql": ("SELECT ", "INSERT INTO", "CREATE TABLE", "WHERE ", "FROM "),
    "shell": ("() {\n", "local ", "\ndone", "echo ", "#!/", "\nfi\n"),
    "css": ("px;", "px ", "em;", "color:"),
    "json": ('": ', '",\n', "},\n"),
    "yaml": ("\n  ", ":\n", ": \""),
    "markdown": ("## ", "\n```", "\n- ", "\n* "),
    "text": (". ", ".\n"),
}
_DOUBLE, _SINGLE = r'"(?:[^"\\\n]|\\.)*"?', r"'(?:[^'\\\n]|\\.)*'?"
_SLASHES, _BLOCK, _HASH = r"//[^\n]*", r"/\*(?:[^*]|\*(?!/))*(?:\*/)?", r"#[^\n]*"
# Strings and comments of each language; what isn't listed has none.
QUOTED = {
    "python": r'"""(?:[^"\\]|\\.|"(?!""))*(?:""")?|' + "|".join((_DOUBLE, _SINGLE, _HASH)),
    "shell": "|".join((_DOUBLE, _SINGLE, r"(?:(?<=\s)|^)#[^\n]*")),
    "yaml": "|".join((_DOUBLE, r"(?:(?<=\s)|^)#[^\n]*")),
    "c": "|".join((_BLOCK, _SLASHES, _DOUBLE, _SINGLE)),
    "java": "|".join((_BLOCK, _SLASHES, _DOUBLE, _SINGLE)),
    "go": "|".join((_BLOCK, _SLASHES, _DOUBLE, r"`[^`]*`?", r"'(?:[^'\\\n]|\\.)'")),
    "javascript": "|".join((_BLOCK, _SLASHES, _DOUBLE, _SINGLE, r"`(?:[^`\\]|\\.)*`?")),
    "css": "|".join((_BLOCK, _DOUBLE)),
    "sql": "|".join((r"--[^\n]*", _BLOCK, r"'(?:[^']|'')*'?", _DOUBLE)),
    "json": _DOUBLE,
    "markdown": r"(?:(?<=\n)|^)```[^\n]*",
}
#: Bytes standing for the inside of strings, line comments and open block comments, an ellipsis, a fence, and a ruled line in a comment.
STRING, COMMENT, BLOCK, ELLIPSIS, FENCE, RULE = 1, 2, 3, 4, 5, 6
_SYMBOLS = (STRING, COMMENT, BLOCK, ELLIPSIS, FENCE, RULE)
# Full stops of other scripts.
STOPS = {0x3002: ord("."), 0xFF0E: ord("."), 0xFF01: ord("!"), 0xFF1F: ord("?"), 0x0964: ord("."), 0x2026: ELLIPSIS}
RULED = np.frombuffer(b"-=*~_", np.uint8)
#: Characters from the start of a text that count as near it.
NEAR = 24
#: Sizes of the context's parts: depth (3: near the start), last, second and third character, line's first word.
DEPTHS, LAST, SECOND, THIRD, WORDS = 4, 64, 16, 8, 64
BINS = DEPTHS * LAST * SECOND * THIRD * WORDS
#: Kind of the texts, and of the positions in all texts, of at most NEAR characters; what is stripped to find blank texts.
TINY, BLANK = "tiny", "\ufeff\u200b \t\r\n\x0b\x0c"
#: Weight of the shorter context, in positions.
KAPPA = 200.0
#: A mark of omission stands within so many last characters.
TAIL = 64
#: Bands of lengths for a power of e: the number of texts expected at a length is the larger one of a broad and a narrow mean.
BANDS = (8, 32)
_ADDED = re.compile(r"[ \t]*(?:\[(?:…|\.\.\.)\]|…)\Z|(?<=[^\s.])\.\.\.\Z|\ufffd+\Z")
_SPACED = re.compile(r"[ \t]*\.\.\.\Z")


@lru_cache(1)
def tables() -> tuple[np.ndarray, ...]:
    """By byte: its part of the code as last, second and third character, its change of depth, whether it is no blank, no line end, a rule."""
    last, second, third = (np.zeros(256, np.int32) for _ in range(3))
    depth = np.zeros(256, np.int8)
    punctuation = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalpha():
            last[b], second[b], third[b] = 8, 1, 1
        elif c.isdigit():
            last[b], second[b], third[b] = 9, 2, 2
        elif c in " \t":
            last[b], second[b], third[b] = 10, 3, 3
        elif c in "\r\n":
            last[b], second[b], third[b] = 11, 4, 4
        elif b in _SYMBOLS:
            last[b], second[b], third[b] = 1 + _SYMBOLS.index(b), 5, 5
        elif b in punctuation:
            last[b] = 16 + punctuation.index(b)
            second[b], third[b] = next(((k, 6) for k, s in enumerate((")]}", "([{", ";", ".!?", ",", ":", "\"'`", "=<>", "-_"), 6) if c in s), (15, 7))
    for a, b in ("()", "[]", "{}"):
        depth[ord(a)], depth[ord(b)] = 1, -1
    every = np.arange(256)
    solid, counted, ruled = ~np.isin(every, (9, 32)), ~np.isin(every, (10, 13)), np.isin(every, RULED)
    return last * (SECOND * THIRD * WORDS), second * (THIRD * WORDS), third * WORDS, depth, solid, counted, ruled


def language(text: str, lang: str | None) -> str:
    """``lang``, unless the text has none of that language's signs but several of another's."""
    score = lambda k: sum(text.count(s) for s in SIGNS[k])
    if lang in SIGNS and (len(text) <= NEAR or score(lang)):
        return lang
    best = max(SIGNS, key=lambda k: (score(k) if k not in ("yaml", "text") else score(k) / 8, k))
    return best if score(best) >= 3 else lang or "text"


def masked(text: str, kind: str) -> np.ndarray:
    """Bytes of the text, one per character, with the inside of strings and comments replaced."""
    out = np.frombuffer(text.encode("ascii", "replace"), np.uint8).copy()
    if not text.isascii():
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        wide = np.flatnonzero(chars >= 128)
        out[wide] = 128
        for c, b in STOPS.items():
            out[wide[chars[wide] == c]] = b
    pattern = _compiled(kind)
    if pattern is not None:
        spans = np.array([m.span() for m in pattern.finditer(text)], np.int64).reshape(-1, 2)
        if len(spans):
            begin, end = spans[:, 0], spans[:, 1]
            first, last = out[begin], out[end - 1]
            quote = np.isin(first, (34, 39, 96))
            closed = quote & (last == first) & (end - begin > 1)
            fence = first == 96 if kind == "markdown" else np.zeros(len(spans), bool)
            fill = np.where(fence, FENCE, np.where(quote, STRING, COMMENT)).astype(np.uint8)
            block = (first == 47) & (out[np.minimum(begin + 1, len(out) - 1)] == 42)
            fill[block] = BLOCK
            done = block & (last == 47) & (out[np.maximum(end - 2, 0)] == 42) & (end - begin > 3)
            size = end - begin
            where = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            filled = np.repeat(fill, size)
            filled[(filled == COMMENT) & tables()[6][out[where]]] = RULE
            out[where] = filled
            out[end[done] - 1] = out[end[done] - 2] = 32  # a closed comment is like white space
            out[begin[quote & ~fence]] = first[quote & ~fence]
            out[end[closed & ~fence] - 1] = first[closed & ~fence]
    return out


@lru_cache(32)
def _compiled(kind: str):
    return re.compile(QUOTED[kind], re.S if kind == "python" else 0) if kind in QUOTED else None


def contexts(b: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(code of the context before each position 1..n, which of them count); line ends count once, before them."""
    last, second, third, change, is_solid, counted, _ = tables()
    n = len(b)
    if kind == "markdown":
        depth = np.cumsum((b == FENCE) & np.concatenate([[True], b[:-1] == 10]), dtype=np.int32) % 2
    elif kind == "text":
        depth = np.zeros(n, np.int32)
    else:
        depth = np.clip(np.cumsum(change[b], dtype=np.int32), 0, 2)
    depth[:NEAR] = 3
    starts = np.concatenate([[0], np.flatnonzero(b[:-1] == 10) + 1])
    sizes = np.diff(np.append(starts, n))
    # The first word of each line: up to 6 letters, or the first other character.
    solid = np.flatnonzero(is_solid[b])
    at = np.minimum(solid[np.minimum(np.searchsorted(solid, starts), max(len(solid) - 1, 0))], n - 1) if len(solid) else starts
    at = np.where(at < starts, starts, at)
    at = np.minimum(at, starts + sizes - 1)
    code, letters, size = b[at].astype(np.int64), np.ones(len(at), bool), np.zeros(len(at), np.int64)
    tail = np.concatenate([b, np.zeros(8, np.uint8)])
    for k in range(6):
        c = tail[at + k]
        letters &= ((c | 32) >= 97) & ((c | 32) <= 122)
        code = np.where(letters, (code * 31 + c + k) % 65_521, code)
        size += letters
    word = ((1 + code % (WORDS // 2 - 1)) * 2 + (at > starts)).astype(np.int32)
    out = depth * (LAST * SECOND * THIRD * WORDS)
    out += last[b]
    out[1:] += second[b[:-1]]
    out[2:] += third[b[:-2]]
    out += np.repeat(word, sizes)
    # Inside that word, which a cut would have ended, it isn't known yet.
    inside = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out[inside] -= np.repeat(word & ~1, size)
    return out, counted[b]


def _end(text: str) -> tuple[str, str]:
    """The text without line ends at its end, and that without an added mark of omission."""
    bare = text.rstrip("\r\n")
    body, tail = bare[:-TAIL], bare[-TAIL:]
    cut = _ADDED.sub("", tail)
    return (body + cut, body + cut) if cut != tail else (bare, body + _SPACED.sub("", tail))


FACTS = "is_count boolean, doc_id long, source string, kind string, code long, code_cut long, n_chars long, n_bytes long, ended_line long, marked long, text_hash long, n_inside long"
_FACTS = pa.schema([("is_count", pa.bool_()), ("doc_id", pa.int64()), ("source", pa.string()), ("kind", pa.string()), *((c, pa.int64()) for c in ("code", "code_cut", "n_chars", "n_bytes", "ended_line", "marked", "text_hash", "n_inside"))])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text that isn't blank, with its final contexts, and rows with the counts of contexts inside texts.

    marked is 2 for a mark of omission that no text of its own would have, 1 for three dots after a blank.
    Tiny texts, and the first positions of all, are a kind of their own.
    """
    inside: dict[str, np.ndarray] = {}

    def add(kind: str, codes: np.ndarray) -> None:
        if kind not in inside:
            inside[kind] = np.zeros(BINS, np.int32)
        inside[kind] += np.bincount(codes, minlength=BINS).astype(np.int32)

    for batch in batches:
        rows, held, n_held = [], {}, {}
        for doc_id, text, lang, source, text_hash in zip(*(c.to_pylist() for c in batch.columns)):
            if text is None or not text.strip(BLANK):
                continue
            kind = language(text, lang)
            bare, cut = _end(text)
            codes, counts = contexts(masked(bare, kind), kind)
            final, final_cut = int(codes[-1]), int(codes[len(cut) - 1]) if cut else int(codes[-1])
            held.setdefault(kind, []).append(codes[NEAR:-1][counts[NEAR:-1]])
            held.setdefault(TINY, []).append(codes[: min(NEAR, len(codes) - 1)][counts[: min(NEAR, len(codes) - 1)]])
            rows.append((False, doc_id, source, kind if len(codes) > NEAR else TINY, final, final_cut, len(text), len(text.encode("utf-8", "surrogatepass")), int(len(text.rstrip("\r\n")) < len(text)), int(len(cut) < len(bare)) + 2 * int(len(bare) < len(text.rstrip("\r\n"))), text_hash, None))
            n_held[kind] = n_held.get(kind, 0) + len(held[kind][-1])
            if n_held[kind] > BINS:
                add(kind, np.concatenate(held.pop(kind)))
                n_held[kind] = 0
        for kind, codes in held.items():
            add(kind, np.concatenate(codes))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FACTS)] if rows else [pa.array([], f.type) for f in _FACTS], schema=_FACTS)
    for kind, counts in inside.items():
        at = np.flatnonzero(counts)
        n = len(at)
        null = lambda t, n=n: pa.nulls(n, t)
        yield pa.RecordBatch.from_arrays([pa.array([True] * n, pa.bool_()), null(pa.int64()), null(pa.string()), pa.array([kind] * n, pa.string()), pa.array(at), *(null(pa.int64()) for _ in range(6)), pa.array(counts[at].astype(np.int64))], schema=_FACTS)


def _levels(code: Column) -> Column:
    """Longer and longer contexts of a code as rows (level, c): depth and last character, second, indent, line's word, third."""
    word, rest = code % WORDS, F.floor(code / WORDS)
    two = F.floor(rest / THIRD)
    all_ = (F.floor(two / SECOND), two, two * 2 + word % 2, two * WORDS + word, code)
    return F.explode(F.array(*(F.struct(F.lit(k).alias("level"), c.cast("long").alias("c")) for k, c in enumerate(all_)))).alias("at")


def going_on(inside: DataFrame) -> DataFrame:
    """(kind, level, c, went_on): how many positions of all texts follow each context, of each length."""
    return inside.select("kind", "n_inside", _levels(F.col("code"))).groupBy("kind", "at.level", "at.c").agg(F.sum("n_inside").alias("went_on"))


def ending_odds(texts: DataFrame, went_on: DataFrame, kappa: float = KAPPA) -> DataFrame:
    """texts (row, kind, code, p, m) with ratio: how much more often complete texts end after the context than positions have it.

    Texts count m times (their copies) with their probability of being complete, the text itself and its
    copies not at all; each longer context's rate of ending is smoothed towards the shorter one's. Contexts
    are a bounded alphabet, so the rates are worked out per context and joined to the texts once. They are
    written before: one plan for all of it takes the driver much memory.
    """
    whole = F.col("m") * (F.lit(1.0) - F.col("p"))
    scratch = Scratch(texts.sparkSession)
    ended, _ = scratch.put(texts.groupBy("kind", "code").agg(F.sum(whole).alias("ended")))
    rows = ended.select("kind", "code", "ended", _levels(F.col("code"))).select("kind", "code", "ended", "at.*")
    sums = rows.groupBy("kind", "level", "c").agg(F.sum("ended").alias("e")).join(went_on, ["kind", "level", "c"], "left").withColumn("g", F.coalesce("went_on", F.lit(0)).cast("double"))
    means = went_on.where("level = 0").groupBy("kind").agg(F.sum("went_on").alias("positions"))
    means = ended.groupBy("kind").agg(F.sum("ended").alias("texts")).join(means, "kind", "left")
    means = means.select("kind", ((F.coalesce("positions", F.lit(0)) + F.col("texts")) / F.greatest("texts", F.lit(1.0))).alias("mean"))
    steps, _ = scratch.put(rows.join(sums, ["kind", "level", "c"]).groupBy("kind", "code").agg(F.array_sort(F.collect_list(F.struct("level", "e", "g"))).alias("steps")).join(means, "kind"))

    def rate(before: Column, x: Column) -> Column:
        others = F.greatest(x["e"] - whole, F.lit(0.0))
        return (others + kappa * before) / (others + x["g"] + kappa)

    out = texts.join(steps, ["kind", "code"])
    return out.withColumn("ratio", F.aggregate("steps", 1 / F.col("mean"), rate) * F.col("mean")).drop("steps", "mean")


def limits(docs: DataFrame, length: str, limit_texts: int = 4, stands_out: float = 16.0) -> DataFrame:
    """(source, the length, same): lengths that so many different texts of a source have that only a limit explains it.

    docs: source, the length, text_hash; copies of a text count once. A length is expected to have the
    mean number of texts of the lengths around it, itself left out. ``stands_out`` times that must be
    exceeded by limit_texts, so that the ratio decides wherever texts abound, whatever the table's size;
    limit_texts alone is the evidence needed where hardly any are expected.
    """
    seen = docs.select("source", length, "text_hash").distinct().groupBy("source", length).agg(F.count(F.lit(1)).alias("same"))
    bands = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.log(length) * k).alias("band")) for k in BANDS))).alias("at")
    seen = seen.where(F.col(length) > 0).select("source", length, "same", bands).select("source", length, "same", "at.*")
    mass = seen.groupBy("source", "k", "band").agg(F.sum("same").alias("mass"))
    around = F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1)))).alias("band")
    near = mass.select("source", "k", around, "mass").groupBy("source", "k", "band").agg(F.sum("mass").alias("near"))
    first, end = (F.ceil(F.exp((F.col("band") + i) / F.col("k"))) for i in (-1, 2))
    others = end - F.greatest(first, F.lit(1)) - 1
    expected = F.max((F.col("near") - F.col("same")) / F.greatest(others, F.lit(1)))
    out = seen.join(near, ["source", "k", "band"]).groupBy("source", length, "same").agg(expected.alias("expected"))
    return out.where(F.col("same") >= limit_texts + stands_out * F.col("expected")).drop("expected")


#: What makes two texts of one source alike for the model; rows equal in all of it are copies and judged once.
UNIT = ["source", "kind", "code", "code_cut", "n_chars", "n_bytes", "ended_line", "marked", "text_hash"]


def truncated(df: DataFrame, doc_id: str, text: str, lang: str, source: str, prior: float = 0.1, limit_texts: int = 4, rounds: int = 3) -> DataFrame:
    """(doc_id, source, kind, p): each text that isn't null, empty or blank with the probability that it was cut.

    prior: share of cut texts to begin with (0.9 for those that end within brackets); the model and the
    shares are then fitted in ``rounds`` passes, per source, per language (tiny texts being one of their
    own) and for lengths (in characters or bytes) that show a limit of the source (see ``limits``). p > 0.5
    says that the ratio of ending to going on is below the odds of these shares: that is the threshold,
    fitted for each source, language and length. Copies of a text weigh as many texts but don't vouch for
    each other, and pseudo-counts are in copies, so that repeating the whole table changes no decision.
    Repeated rows are judged one by one; a null language is guessed from the text, a null source is one of
    its own; other columns are ignored; an empty table gives no rows. Whole texts are read, of any length.
    """
    scratch = Scratch(df.sparkSession)
    picked = df.select(F.col(doc_id).cast("long"), F.col(text).cast("string"), F.col(lang).cast("string"), F.coalesce(F.col(source).cast("string"), F.lit("")), F.xxhash64(F.col(text).cast("string")))
    facts, _ = scratch.put(picked.mapInArrow(_facts, FACTS))
    inside = facts.where("is_count").groupBy("kind", "code").agg(F.sum("n_inside").alias("n_inside"))
    went_on, _ = scratch.put(going_on(inside))
    docs = facts.where("not is_count").select("doc_id", *UNIT)
    units, _ = scratch.put(docs.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("m")))
    n, copies = units.agg(F.sum("m"), F.avg("m")).first()
    if not n:
        return docs.select(F.col("doc_id").alias(doc_id), F.col("source").alias(source), "kind", F.lit(None).cast("double").alias("p"))
    texts = units
    for c in ("n_chars", "n_bytes"):
        texts = texts.join(scratch.put(limits(units, c, limit_texts).withColumnRenamed("same", f"same_{c}"))[0], ["source", c], "left")
    # A mark of omission with a blank before it is an added one where texts of that length abound.
    at_limit = F.coalesce("same_n_chars", "same_n_bytes").isNotNull()
    depth = F.floor(F.col("code") / (LAST * SECOND * THIRD * WORDS))
    texts = texts.withColumn("unit", F.struct(*UNIT))
    texts = texts.withColumn("code", F.when(at_limit, F.col("code_cut")).otherwise(F.col("code"))).drop("code_cut", "text_hash")
    texts = texts.withColumn("marked", ((F.col("marked") == 2) | ((F.col("marked") == 1) & at_limit)).cast("int"))
    texts = texts.withColumn("is_open", depth.isin(1, 2)).withColumn("p", F.when(F.col("is_open"), 0.9).otherwise(prior))
    judged, judged_at = scratch.put(texts)
    cut, m, two = F.sum(F.col("m") * F.col("p")), F.sum("m"), 2 * copies
    for _ in range(rounds):
        now = ending_odds(judged, went_on, KAPPA * copies)
        # Whether a line end or a mark of omission is there tells something too, where a source's cut texts never or always have one.
        signs = ("ended_line", "marked")
        sums = [x for c in signs for x in (F.sum(F.col("m") * F.col("p") * F.col(c)).alias(f"cut_{c}"), F.sum(F.col("m") * F.col(c)).alias(f"all_{c}"))]
        now = now.join(judged.groupBy("source").agg(cut.alias("cut"), m.alias("n"), *sums), "source")

        def share(c: str, having: Column, n: Column) -> Column:
            return F.when(F.col(c) == 1, having).otherwise(n - having) / n

        of = [share(c, F.col(f"cut_{c}") + copies, F.col("cut") + two) / share(c, F.col(f"all_{c}") - F.col(f"cut_{c}") + copies, F.col("n") - F.col("cut") + two) for c in signs]
        now = now.withColumn("pi", (F.col("cut") + two * prior) / (F.col("n") + two)).withColumn("line", of[0] * of[1])
        now = now.drop("cut", "n", *(f"{x}_{c}" for x in ("cut", "all") for c in signs))
        # A language in which more, or fewer, texts are cut than in all shifts the odds of a source by that much.
        kinds = judged.groupBy("kind").agg(cut.alias("cut_kind"), m.alias("n_kind"))
        overall = judged.agg(((cut + two * prior) / (m + two)).alias("pi_all"))
        now = now.join(kinds.crossJoin(F.broadcast(overall)), "kind")  # one row
        of_kind = (F.col("cut_kind") + two * F.col("pi_all")) / (F.col("n_kind") + two)
        odds = lambda x: x / (1 - x)
        shifted = odds(F.col("pi")) * odds(of_kind) / odds(F.col("pi_all"))
        now = now.withColumn("pi", shifted / (1 + shifted)).drop("cut_kind", "n_kind", "pi_all")
        for c in ("n_chars", "n_bytes"):
            same = judged.where(F.col(f"same_{c}").isNotNull()).groupBy("source", c).agg(cut.alias(f"cut_{c}"), m.alias(f"n_{c}_"))
            now = now.join(same, ["source", c], "left")
            now = now.withColumn(f"pi_{c}", (F.col(f"cut_{c}") + two * F.col("pi")) / (F.col(f"n_{c}_") + two)).drop(f"cut_{c}", f"n_{c}_")
        # Texts that end within brackets are cut where complete ones of their language never do.
        within = judged.where("is_open").groupBy("kind", "is_open").agg(((cut + two * prior) / (m + two)).alias("pi_open"))
        now = now.join(within, ["kind", "is_open"], "left")
        pi = F.least(F.greatest("pi", "pi_n_chars", "pi_n_bytes", "pi_open"), F.lit(0.98))
        now = now.withColumn("odds", odds(pi) * F.col("line") / F.greatest("ratio", F.lit(0.001)))
        now = now.withColumn("p", F.col("odds") / (1 + F.col("odds"))).drop("pi", "pi_n_chars", "pi_n_bytes", "pi_open", "line", "ratio", "odds")
        before, (judged, judged_at) = judged_at, scratch.put(now)
        scratch.drop(before)
    found, _ = scratch.put(judged.select("unit.*", "p"))
    return docs.join(found, UNIT).select(F.col("doc_id").alias(doc_id), F.nullif(F.col("source"), F.lit("")).alias(source), "kind", "p")
