"""Recursive text splitting as a table function, and the retrieval it serves: split, vector, nearest chunks, prompt.

A text is cut at the first separator that it has (paragraphs, lines, words, characters); parts that are still too long are cut at
the next one, and short neighbours are merged up to the size, with the last of them repeated at the next chunk's start as far as the
overlap allows. A separator stays with the part behind it; chunks are trimmed and empty ones left out.

Defined results: a null, empty or blank text has no chunks; very long texts are split whole, each in one task; repeated
rows are split each by itself; sizes count characters.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.maths import search_score

SEPARATORS = ("\n\n", "\n", " ", "")
#: Where a model's text has sections of its own.
SECTIONS = ("Model Name:", "== Model Properties ==")
#: A section of up to so many sizes stays whole.
SECTION_SLACK = 1.5


def _parts(text: str, separator: str) -> Iterator[str]:
    """The text's parts, each with the separator before it."""
    if not separator:
        yield from text
        return
    cuts = [0, *(at for at in _places(text, separator) if at), len(text)]
    yield from (text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a)


def _merged(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    held: deque[str] = deque()
    total = 0
    for part in parts:
        if held and total + len(part) > size:
            yield "".join(held)
            while held and (total > overlap or total + len(part) > size):
                total -= len(held.popleft())
        held.append(part)
        total += len(part)
    if held:
        yield "".join(held)


def split(text: str, size: int = 1000, overlap: int = 200, separators: tuple[str, ...] = SEPARATORS) -> Iterator[str]:
    """The chunks of one text."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    short: list[str] = []
    for part in _parts(text, separators[at]):
        if len(part) < size:
            short.append(part)
            continue
        yield from _trimmed(_merged(short, size, overlap))
        short = []
        if at + 1 < len(separators):
            yield from split(part, size, overlap, separators[at + 1 :])
        else:
            yield from _trimmed(iter([part]))
    yield from _trimmed(_merged(short, size, overlap))


def _trimmed(chunks: Iterator[str]) -> Iterator[str]:
    return (c for c in (c.strip() for c in chunks) if c)


def split_sections(text: str, size: int = 1000, overlap: int = 200, sections: tuple[str, ...] = SECTIONS) -> Iterator[str]:
    """The chunks of a text with sections: cut where a section starts, and further only where one is much too long."""
    starts = sorted({at for s in sections for at in _places(text, s)})
    if not starts:
        yield from split(text, size, overlap)
        return
    bounds = sorted({0, *starts, len(text)})
    for a, b in zip(bounds, bounds[1:]):
        section = text[a:b].strip()
        if len(section) > size * SECTION_SLACK:
            yield from split(section, size, overlap)
        elif section:
            yield section


def _places(text: str, mark: str) -> Iterator[int]:
    at = text.find(mark)
    while at >= 0:
        yield at
        at = text.find(mark, at + len(mark))


@F.udtf(returnType=T.StructType([T.StructField("n", T.IntegerType()), T.StructField("chunk", T.StringType())]))
class SplitText:
    """A row for each chunk of a text, in order; by_section: cut at sections first."""

    def eval(self, text: str, size: int, overlap: int, by_section: bool) -> Iterator[tuple[int, str]]:
        if text:
            yield from enumerate((split_sections if by_section else split)(text, size, overlap))


def chunks(docs: DataFrame, text: Column, size: int = 1000, overlap: int = 200, by_section: bool = False) -> DataFrame:
    """The documents' columns with n and chunk, a row for each chunk."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be less than the size")
    rows = docs.withColumn("__text", text)
    made = SplitText(F.col("__text").outer(), F.lit(size), F.lit(overlap), F.lit(by_section))
    return rows.lateralJoin(made).drop("__text")


def hashed_vector(text: Column, dims: int = 64) -> Column:
    """A text's words counted in `dims` slots by their hash: a stand-in for a trained embedding.

    The slots are sorted with each possible one put in once more, so a slot's count is the distance from its first place to the
    next one's: no vector is built for each word.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
    slots = F.transform(words, lambda w: F.pmod(F.crc32(w), F.lit(dims)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(dims))
    # transform() over an array of one binds a value: a lambda evaluates all that it names from outside again and again
    firsts = F.transform(F.array(F.sort_array(F.concat(slots, every))), lambda s: F.transform(every, lambda i: F.array_position(s, i)))
    counts = F.transform(firsts, lambda at: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: (F.get(at, i + 1) - F.get(at, i) - 1).cast("double")))
    return F.get(counts, F.lit(0))


def nearest_chunks(chunked: DataFrame, question: str, id_cols: list[str], k: int = 3) -> DataFrame:
    """The k chunks nearest to a question, best first, ties by id, then by chunk; chunks without words are left out.

    Rows without words are filtered by their text: a filter on a vector or a score would compute these once more in each place.
    """
    spoken = lambda text: text.rlike(r"[\p{L}\p{N}]")
    asked = F.array(*[F.lit(v) for v in chunked.sparkSession.range(1).select(hashed_vector(F.lit(question))).first()[0]])
    rows = chunked.filter(spoken(F.col("chunk")) & spoken(F.lit(question)))
    vectors = rows.select(F.struct(*id_cols, "n").alias("key"), "chunk", hashed_vector(F.col("chunk")).alias("vector"))
    scored = vectors.select("key", "chunk", search_score(F.col("vector"), asked).alias("score"))
    return scored.orderBy(F.desc("score"), "key", "chunk").limit(k)


def answer_prompt(found: DataFrame, question: str, template: str = "Context:\n{context}\n\nQuestion: {question}\nAnswer:") -> DataFrame:
    """One row: the prompt of the found chunks (k of them), best first, with the question."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "key", "chunk")))
    context = F.array_join(F.transform(ordered, lambda x: x["chunk"]), "\n\n")
    head, tail = template.split("{context}")
    fill = lambda s: F.lit(s.replace("{question}", question))
    return found.agg(F.concat(fill(head), context, fill(tail)).alias("prompt"))
