"""Identifier, citation and reference-text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.dims import DOI_IN_REFERENCE, DOI_IN_TEXT, SECRET_RULES, SECRET_SCAN_SKIP_SUFFIXES
from cairn.functions.parse import strip

SURNAME = r"^\s*([A-Za-z][A-Za-z'\-]+)"


def extract_dois(text: Column) -> Column:
    """Distinct DOIs in order of first occurrence, trailing punctuation removed."""
    found = F.regexp_extract_all(text, F.lit(DOI_IN_TEXT), F.lit(0))
    return F.array_distinct(
        F.transform(found, lambda d: F.regexp_replace(d, r"[.,;)\]]+$", ""))
    )


def reference_dois(text: Column) -> Column:
    """Every DOI occurrence of a reference line, in order, duplicates kept."""
    found = F.regexp_extract_all(text, F.lit(DOI_IN_REFERENCE), F.lit(0))
    return F.transform(found, lambda d: F.regexp_replace(d, r"[.,;:)]+$", ""))


def surname(citation: Column) -> Column:
    """Leading surname of a citation, NULL when it does not start with a name."""
    s = F.regexp_extract(citation, SURNAME, 1)
    return F.when(s != "", s)


def doi_from_url(*texts: Column) -> Column:
    """DOI after ``doi.org/`` in the first text that has one."""

    def one(t: Column) -> Column:
        tail = F.regexp_replace(F.regexp_extract(t, r"(?s)doi\.org/(.*)$", 1), r"^[\s/]+|[\s/]+$", "")
        return F.when(t.contains("doi.org/"), F.regexp_extract(tail, r"^\S+", 0))

    picked = F.coalesce(*[one(t) for t in texts])
    return F.when(picked != "", picked)


def title_candidate(line: Column) -> Column:
    """What one line offers as a title: its bold text, and its cleaned text if 6-199 long."""
    s = strip(F.regexp_replace(line, r"^[\s\d\-\*\.\):#]+", ""))
    s = strip(F.regexp_replace(s, DOI_IN_REFERENCE, ""))
    s = strip(F.regexp_replace(s, r"https?://\S+", ""))
    bold = strip(F.regexp_extract(s, r"\*\*([^*]+)\*\*", 1))
    return F.struct(
        F.when(s.rlike(r"\*\*([^*]+)\*\*"), bold).alias("bold"),
        F.when((F.length(s) > 5) & (F.length(s) < 200), s).alias("plain"),
    )


def guess_title(here: Column, one_up: Column, two_up: Column) -> Column:
    """Bold text of the nearest line that has some, else the nearest plain line."""
    spots = [title_candidate(line) for line in (here, one_up, two_up)]
    return F.coalesce(
        *[s["bold"] for s in spots], *[s["plain"] for s in spots], F.lit("")
    )


def shorten(text: Column, limit: int, mark: str = "...") -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))
    ).otherwise(text)


def file_id(dataset_id: Column, path: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", dataset_id, path), 256), 1, 16)


def chunk_id(paper_id: Column, abstract: Column) -> Column:
    digest = F.substring(F.sha2(F.coalesce(abstract, F.lit("")), 256), 1, 12)
    return F.concat(paper_id, F.lit("_abstract_"), digest)


def download_id(dataset_id: Column, checksum: Column) -> Column:
    return F.concat_ws("_", dataset_id, F.substring(checksum, 1, 8))


def format_bytes(n: Column) -> Column:
    """B, KB and MB with one decimal, GB with two; ties go to the even digit, as in C's printf."""
    text = lambda unit, size, digits: F.format_string(f"%.{digits}f{unit}", F.rint(n * 10.0**digits / size) / 10.0**digits)
    return (
        F.when(n < 1024, F.format_string("%dB", n))
        .when(n < 1024**2, text("KB", 1024.0, 1))
        .when(n < 1024**3, text("MB", 1024.0**2, 1))
        .otherwise(text("GB", 1024.0**3, 2))
    )


def secret_hits(text: Column) -> Column:
    """Names of the rules that match, as an array; no join against the rules."""
    return F.array_compact(
        F.array(*[F.when(text.rlike(rule), F.lit(name)) for name, rule in SECRET_RULES])
    )


def scan_skipped(path: Column) -> Column:
    """Files the secret scan leaves out: binary formats, by suffix."""
    skipped = F.lit(False)
    for suffix in SECRET_SCAN_SKIP_SUFFIXES:
        skipped = skipped | F.lower(path).endswith(suffix)
    return skipped


def missing_sentinel(definition: Column) -> Column:
    """The value listed after ``missing values =`` up to a full stop or line end."""
    tail = F.regexp_extract(definition, r"(?i)missing values =\s*([^.\n]*)", 1)
    tail = strip(tail)
    tail = F.regexp_replace(tail, "^['\"‘’]+|['\"‘’]+$", "")
    return F.when(tail != "", tail)


def _product_error(a: Column, b: Column, product: Column) -> Column:
    """What rounding took off ``a * b``, exactly (Dekker)."""
    halves = lambda x: (x * 134217729.0 - (x * 134217729.0 - x), x - (x * 134217729.0 - (x * 134217729.0 - x)))
    (ah, al), (bh, bl) = halves(a), halves(b)
    return ((ah * bh - product) + ah * bl + al * bh) + al * bl


def _once(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), 0)


def _whole(a: Column, power: Column) -> Column:
    """``a`` times ten to the ``power`` as a whole number, rounded as C's printf does: by the exact binary value,
    ties to even.  Java's formatter rounds the shortest decimal text half up.  For powers up to 22 either way."""

    def rounded(x):
        a, ten, p = x["a"], x["ten"], x["p"]
        off = F.when(x["up"], _product_error(a, ten, p)).otherwise((a - p * ten) - _product_error(p, ten, p * ten))
        side = F.when(off > 0, F.ceil(p).cast("double")).when(off < 0, F.floor(p).cast("double")).otherwise(F.rint(p))
        return F.when(F.abs(p - F.rint(p)) == 0.5, side).otherwise(F.rint(p))

    def scaled(x):
        p = F.when(x["up"], x["a"] * x["ten"]).otherwise(x["a"] / x["ten"])
        return _once(F.struct(x["a"].alias("a"), x["ten"].alias("ten"), x["up"].alias("up"), p.alias("p")), rounded)

    return _once(F.struct(a.alias("a"), F.pow(F.lit(10.0), F.abs(power)).alias("ten"), (power >= 0).alias("up")), scaled)


def fixed(value: Column, digits: int) -> Column:
    """A number with ``digits`` decimals, as C's printf writes it."""

    def text(v):
        n = F.format_string("%.0f", _whole(F.abs(v), F.lit(digits)))
        return F.when(F.abs(v) < 1e13, _once(n, lambda n: signed(v, n))).otherwise(F.format_string(f"%.{digits}f", v))

    def signed(v, n):
        n = F.lpad(n, F.greatest(F.length(n), F.lit(digits + 1)), "0")
        sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
        return F.concat(sign, F.substr(n, F.lit(1), F.length(n) - digits), F.lit("."), F.right(n, F.lit(digits)))

    return _once(value, text)


def general(value: Column, digits: int = 3) -> Column:
    """A number in ``digits`` significant digits, plain or with an exponent, without trailing zeros, as C's printf writes it."""
    bare = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")

    def text(x):
        full, first = x["full"], x["first"]
        far = F.concat(bare(F.substring_index(full, "e", 1)), F.lit("e"), F.substring_index(full, "e", -1))
        known = F.when((x["size"] > 0) & (x["size"] < F.pow(F.lit(10.0), first)), first - 1).otherwise(first)
        sign = F.when(full.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        near = F.concat(sign, _once(known, lambda k: _once(F.struct(k.alias("k"), _whole(x["size"], F.lit(digits - 1) - k).alias("n")), written)))
        return (
            F.when(F.isnan(x["v"]), F.lit("nan")).when(first.isNull(), F.lower(full))
            .when(F.abs(first) > 18, far).otherwise(near)
        )

    def written(x):
        more = x["n"] >= 10.0**digits
        n = F.lpad(F.format_string("%.0f", F.when(more, x["n"] / 10).otherwise(x["n"])), digits, "0")
        return _once(F.struct(F.when(more, x["k"] + 1).otherwise(x["k"]).alias("power"), n.alias("n")), placed)

    def placed(x):
        n, power = x["n"], x["power"]
        left = F.greatest(power + 1, F.lit(0))  # digits before the point
        plain = F.concat(
            F.when(left == 0, F.lit("0")).otherwise(F.substr(n, F.lit(1), left)), F.lit("."),
            F.repeat(F.lit("0"), F.greatest(-power - 1, F.lit(0))), F.substr(n, left + 1),
        )
        short = F.concat(bare(F.concat(F.left(n, F.lit(1)), F.lit("."), F.substr(n, F.lit(2)))), F.format_string("e%+03d", power))
        return F.when((power >= -4) & (power < digits), bare(plain)).otherwise(short)

    def measured(v):
        full = F.format_string(f"%.{digits - 1}e", v)
        first = F.substring_index(full, "e", -1).try_cast("int")
        return _once(F.struct(v.alias("v"), F.abs(v).alias("size"), full.alias("full"), first.alias("first")), text)

    return _once(value, measured)
