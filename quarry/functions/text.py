"""Text functions of model records: tags, labels, citations, cards, search text. Pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.maths import scaled_half_even

Strings = "array<string>"


def empty_strings() -> Column:
    return F.array().cast(Strings)


def tag_values(tags: Column, prefix: str) -> Column:
    """Values of the tags with a prefix, each once, in order; the prefix is removed wherever it stands in the tag."""
    own = F.filter(F.coalesce(tags, empty_strings()), lambda t: F.startswith(t, F.lit(prefix)))
    return F.array_distinct(F.transform(own, lambda t: F.trim(F.replace(t, F.lit(prefix), F.lit("")))))


def base_model_tags(tags: Column) -> Column:
    """Base models: what follows the last colon of the tags that start with base_model:."""
    own = F.filter(F.coalesce(tags, empty_strings()), lambda t: F.startswith(t, F.lit("base_model:")))
    return F.array_distinct(F.transform(own, lambda t: F.trim(F.substring_index(t, ":", -1))))


def arxiv_ids(text: Column) -> Column:
    """arXiv numbers in a text, without versions, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b(\d{4}\.\d{4,5})(v\d+)?\b"), 1))


def strip_arxiv_version(value: Column) -> Column:
    """The last part of an address or id, without its version."""
    return F.regexp_replace(F.substring_index(value, "/", -1), r"v\d+$", "")


def strip_front_matter(card: Column) -> Column:
    """A card without the block between two --- lines at its start."""
    return F.trim(F.regexp_replace(F.coalesce(card, F.lit("")), r"(?s)\A---\s*\n.*?\n---\s*\n?", ""))


def strip_front_matter_loose(card: Column) -> Column:
    """The same for any ---...--- at the start, line ends or not."""
    return F.trim(F.regexp_replace(F.coalesce(card, F.lit("")), r"(?s)\A---.*?---\s*", ""))


def short_name(model: Column) -> Column:
    return F.substring_index(model, "/", -1)


def size_label(model: Column) -> Column:
    """A size such as 7B or 1.5B anywhere in the last part of a name, in upper case; null if there is none."""
    return F.nullif(F.upper(F.regexp_extract(short_name(model), r"(?i)(\d+(\.\d+)?[BM])", 1)), F.lit(""))


def size_token(model: Column) -> Column:
    """A size that stands as a word of its own behind the first slash, as written; null if there is none."""
    name = F.when(F.contains(model, F.lit("/")), F.substr(model, F.instr(model, "/") + F.lit(1))).otherwise(model)
    return F.nullif(F.regexp_extract(name, r"(?i)\b(\d+(\.\d+)?[BM])\b", 1), F.lit(""))


def format_count(value: Column) -> Column:
    """A parameter count with T, B, M or K and at most two decimals, no trailing zeros.

    Rounds half away from zero in decimal; binary rounding can differ in the last place for exact halves.
    """
    out = value.cast("string")
    for power, unit in ((3, "K"), (6, "M"), (9, "B"), (12, "T")):
        part = F.round(value.cast("decimal(30,0)") / F.lit(10**power).cast("decimal(20,0)"), 2).cast("string")
        trimmed = F.regexp_replace(F.regexp_replace(part, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        out = F.when(value >= 10**power, F.concat(trimmed, F.lit(unit))).otherwise(out)
    return out


def count_label(value: Column) -> Column:
    """A parameter count with T, B, M or K and at most two decimals, no trailing zeros, by the quotient's exact value.

    1005 is 1K, as the double nearest to 1.005 lies below it; exact ties go to even. Null stays null, counts under 1000
    stay plain. For counts below 10^16; from there on the label has two decimals all the same.
    """
    out = value.cast("string")
    for power, unit in ((3, "K"), (6, "M"), (9, "B"), (12, "T")):
        hundredths = scaled_half_even(value.cast("double") / F.lit(10.0**power), 2).cast("decimal(20,0)")
        part = (hundredths / F.lit(100).cast("decimal(3,0)")).cast("decimal(20,2)").cast("string")
        trimmed = F.regexp_replace(F.regexp_replace(part, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        out = F.when(value >= 10**power, F.concat(trimmed, F.lit(unit))).otherwise(out)
    return out


def scaled_number(text: Column) -> Column:
    """12.3K -> 12300: the number with its K, M or B factor; null if there is none."""
    number = F.nullif(F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    unit = F.upper(F.regexp_extract(text, r"\d\s*([KkMmBb])\b", 1))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)
    return F.round(number * factor).cast("long")


DOI = r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"


def dois(text: Column, most: int = 5) -> Column:
    """Digital object identifiers in a text, lower case, without trailing stops, each once, the first few."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({DOI})"), 1)
    return F.slice(F.array_distinct(F.transform(found, lambda d: F.lower(F.regexp_replace(d, r"[.,;)]+$", "")))), 1, most)


def doi_uri(doi: Column) -> Column:
    """The address of an identifier, however it was written; null if it is none."""
    bare = F.lower(F.regexp_replace(F.trim(doi), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", ""))
    return F.when(bare.rlike(f"^{DOI}$"), F.concat(F.lit("https://doi.org/"), bare))


def bibtex_field(entry: Column, field: str) -> Column:
    """A field's value in a BibTeX entry, in braces, quotes or bare; null if it is missing."""
    pattern = rf'(?is)\b{field}\s*=\s*(?:\{{+([^{{}}]*)\}}+|"([^"]*)"|(\d+))'
    parts = [F.nullif(F.trim(F.regexp_extract(entry, pattern, g)), F.lit("")) for g in (1, 2, 3)]
    return F.regexp_replace(F.coalesce(*parts), r"\s+", " ")


def bibtex_authors(blob: Column) -> Column:
    """Names of an author field: split at "and" and at commas."""
    names = F.flatten(F.transform(F.split(F.trim(F.coalesce(blob, F.lit(""))), r"\s+and\s+"), lambda p: F.split(p, r"\s*,\s*")))
    return F.filter(F.transform(names, lambda x: F.trim(x)), lambda n: n != "")


#: Parts of lower-case names that mark an organisation, with the blanks that keep "Vincent" a person.
ORGANISATIONS = (
    "university",
    "institute",
    " inc",
    " ltd",
    " lab",
    "google",
    "microsoft",
    "meta ",
    "anthropic",
    "openai",
    "foundation",
    "corporation",
    " gmbh",
)


def author_kind(name: Column) -> Column:
    """Organization if a name has one of the marks, else Person."""
    low = F.lower(name)
    hit = F.lit(False)
    for word in ORGANISATIONS:
        hit = hit | F.contains(low, F.lit(word))
    return F.when(hit, "Organization").otherwise("Person")


def year_date(year: Column) -> Column:
    return F.when(year.rlike(r"^\d{4}$"), F.concat(year, F.lit("-01-01")))


def task_token(value: Column) -> Column:
    """A task's name as a token: lower case, blanks and underscores as single hyphens."""
    return F.regexp_replace(F.translate(F.lower(F.trim(value)), " _", "--"), "-{2,}", "-")


def ui_url(iri: Column, graph: str, ui: str) -> Column:
    return F.replace(iri, F.lit(graph), F.lit(ui))


def keyword_tags(tags: Column, most_words: int = 4) -> Column:
    """Tags that can be keywords: no entity prefix, not blank, few words; each once."""
    reserved = ("dataset:", "arxiv:", "base_model:", "license:")

    def free(tag: Column) -> Column:
        out = F.trim(tag) != ""
        for prefix in reserved:
            out = out & ~F.startswith(tag, F.lit(prefix))
        return out & (F.size(F.split(tag, " ")) <= most_words)

    return F.array_distinct(F.transform(F.filter(F.coalesce(tags, empty_strings()), free), lambda x: F.trim(x)))


def keyword_cell(cell: Column) -> Column:
    """A cell that holds a JSON list, or names between commas."""
    listed = F.from_json(cell, Strings)
    parts = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.when(F.startswith(F.trim(cell), F.lit("[")) & listed.isNotNull(), F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != "")).otherwise(parts))


#: Tasks and the patterns that show them, in the order in which they are tried; case does not matter.
TASK_PATTERNS = (
    ("instance-segmentation", r"\binstance[\s_-]*segmentation\b"),
    ("semantic-segmentation", r"\bsemantic[\s_-]*segmentation\b"),
    ("image-segmentation", r"\bsegmentation\b"),
    ("image-classification", r"\bclassification\b"),
    ("object-detection", r"\b(object[\s_-]*)?detection\b"),
    ("image-restoration", r"\brestoration\b"),
    ("image-denoising", r"\bdenois\w*\b"),
    ("image-super-resolution", r"\bsuper[\s_-]*resolution\b"),
    ("image-inpainting", r"\binpaint\w*\b"),
    ("object-tracking", r"\btracking\b"),
    ("image-registration", r"\bregistration\b"),
    ("object-counting", r"\bcounting\b"),
)


def tasks_in(text: Column, patterns=TASK_PATTERNS) -> Column:
    """Tasks whose pattern a text meets, in the patterns' order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(t)) for t, p in patterns]))


def tag_token(tag: Column) -> Column:
    """A tag as a token: task_token() without hyphens at its ends."""
    return F.regexp_replace(task_token(tag), "^-+|-+$", "")


def tasks_of(tags: Column, description: Column, documentation: Column) -> Column:
    """Tasks from the tags, else from the description, else from the documentation."""
    first, second, third = tasks_in(F.array_join(F.transform(F.coalesce(tags, empty_strings()), tag_token), " ")), tasks_in(description), tasks_in(documentation)
    return F.when(F.size(first) > 0, first).when(F.size(second) > 0, second).otherwise(third)


def is_meaningful(value: Column) -> Column:
    """Not null, not blank and not NA."""
    return F.coalesce((F.trim(value) != "") & (F.upper(F.trim(value)) != "NA"), F.lit(False))


def append_unique(values: Column, value: Column) -> Column:
    return F.array_distinct(F.array_append(F.coalesce(values, empty_strings()), value))


def as_list(value: Column) -> Column:
    return F.when(value.isNull(), empty_strings()).otherwise(F.array(value.cast("string")))


def query_terms(query: Column) -> Column:
    """Terms of a search: neighbouring words as written and in lower case, and the whole query; each once."""
    words = F.concat(F.split(query, r"[ \-_\.]"), F.split(F.lower(query), r"[ \-_\.]"))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    terms = F.transform(F.concat(pairs, F.array(query)), lambda x: F.trim(x))
    return F.array_distinct(F.filter(terms, lambda t: t != ""))


#: Words a search can do without.
STOP_WORDS = ("a an and are as at be by can find for from give have i in is it list me model models of on or please search show that the to want which with").split()


def quoted_phrases(query: Column) -> Column:
    """What a query has between double quotes, in lower case."""
    return F.regexp_extract_all(F.lower(F.trim(query)), F.lit('"([^"]+)"'), 1)


def query_tokens(query: Column) -> Column:
    """The other words of a query: lower case, no signs but hyphens and stops, longer than two, no stop words."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(query)), '"[^"]+"', ""), r"[^a-z0-9\-. ]+", " ")
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(F.split(bare, " +"), lambda w: (F.length(w) > 2) & ~F.array_contains(stops, w))


def clean_query(query: Column) -> Column:
    """query_tokens() as one text."""
    return F.array_join(query_tokens(query), " ")


def parameter_labels(counts: Column, total: Column, model: Column) -> Column:
    """Map of counts by kind as labels: each kind's count, else the total, else the size in the name; null if there is none.

    counts and total are null where a record has no weights metadata; a total of 0 has no label.
    """
    by_kind = F.when(F.size(counts) > 0, F.transform_values(counts, lambda _, v: count_label(v)))
    whole = F.when(total.isNotNull(), F.create_map(F.lit("total"), F.when(total > 0, count_label(total))))
    named = F.when(size_label(model).isNotNull(), F.create_map(F.lit("total"), size_label(model)))
    return F.coalesce(by_kind, whole, named)


def without_size(name: Column) -> Column:
    """A model's name without size and version marks such as -7B, -small, -large, -XL and -v2."""
    out = name
    for mark in (r"-\d+[bB]", "-[Ss]mall", "-[Mm]edium", "-[Ll]arge", "-[Xx][Ll]", r"-v\d+"):
        out = F.regexp_replace(out, mark, "")
    return F.trim(out)


def site_of(url: Column) -> Column:
    """The identifier of the site that an address belongs to; null if it is none of the known ones."""
    has = lambda part: F.contains(url, F.lit(part))
    # fixed values: identifiers of the sites
    return (
        F.when(has("huggingface.co"), "https://ror.org/02grspc61")
        .when(has("openml"), "https://www.openml.org")
        .when(has("bioimage.io"), "https://ai4life.eurobioimaging.eu")
    )


def people(cell: Column) -> Column:
    """array<struct(name, url)> of a cell with a JSON list of people or names, or one name: the ORCID's or the code host's address."""
    kind = "array<struct<name: string, orcid: string, github_user: string>>"
    person = lambda n, u: F.struct(F.coalesce(n, F.lit("")).alias("name"), u.alias("url"))
    address = lambda p: (
        F.when(F.coalesce(p["orcid"], F.lit("")) != "", F.concat(F.lit("https://orcid.org/"), p["orcid"]))
        .when(F.coalesce(p["github_user"], F.lit("")) != "", F.concat(F.lit("https://github.com/"), p["github_user"]))
        .otherwise("")
    )
    bare = F.trim(cell)
    listed = F.transform(F.from_json(F.when(bare.startswith("{"), F.concat(F.lit("["), bare, F.lit("]"))).otherwise(bare), kind), lambda p: person(p["name"], address(p)))
    names = F.transform(F.from_json(bare, Strings), lambda n: person(n, F.lit("")))
    plain = F.when(bare != "", F.array(person(cell, F.lit("")))).otherwise(F.array().cast("array<struct<name: string, url: string>>"))
    return F.when(bare.rlike(r'^(\[\s*)?\{'), listed).when(bare.rlike(r'^\[\s*"'), names).otherwise(plain)


def json_pick(json: Column, *paths: str) -> Column:
    """The first path of a JSON text that holds a plain value: fields that may be texts, lists or objects."""
    plain = lambda v: F.when(~F.coalesce(v, F.lit("[")).rlike(r"^\s*[\[{]"), v)
    return F.coalesce(*[plain(F.get_json_object(json, p)) for p in paths])


def json_list(json: Column, path: str) -> Column:
    """A JSON field as a list: of its elements, or of its one value."""
    value = F.get_json_object(json, path)
    return F.when(F.trim(value).startswith("["), F.filter(F.from_json(value, Strings), lambda x: F.coalesce(x, F.lit("")) != "")).when(value != "", F.array(value)).otherwise(empty_strings())


def clip_at_word(text: Column, size: int) -> Column:
    """At most `size` characters, ending with a whole word."""
    cut = F.regexp_replace(F.substring(text, 1, size), r"\s+\S*$", "")
    return F.when(F.length(text) > size, F.concat(cut, F.lit("..."))).otherwise(text)


def file_size(size: Column) -> Column:
    """Bytes in the largest unit that leaves at least one, with two decimals."""
    out = F.format_string("%.2f B", size.cast("double"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(size >= 1024**power, F.format_string(f"%.2f {unit}", size / float(1024**power))).otherwise(out)
    return out


def searchable_text(parts: list[tuple[str, Column]], most: int = 500) -> Column:
    """Sentences "Label: value." for each part that has a value, in order; each value cut at `most` characters."""
    said = [F.when(is_meaningful(v), F.concat(F.lit(f"{label}: "), F.substring(F.trim(v), 1, most), F.lit("."))) for label, v in parts]
    return F.concat_ws(" ", *said)


def json_block(text: Column) -> Column:
    """The JSON object in a model's answer: fences stripped, from the first brace to the last; null if there is none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"```(?:json)?", "")
    return F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit(""))
