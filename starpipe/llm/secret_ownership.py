"""Secret scans with corpus-wide ownership frequency; DataFrame functions only.

Patterns find candidates in every whole text. Candidate values are hashed,
and each hash is counted by distinct repositories and distinct owners over
the corpus: a value that more than ``max_owners`` owners or ``max_repos``
repositories hold is a widely copied example, any other one looks live and
owner-specific. Where documents have no repository (``repo_col`` is None),
owners alone decide: a value of few owners is live in however many documents
it stands. Base kinds are always
reported; the further kinds add a span only where the value looks live.

Matches are few and small next to the texts, and only they are shuffled: the
counts per hash combine before the shuffle, so a value that a third of all
documents holds costs one row a task.

Positions come from the pieces between matches: ``split`` gives the text
between them and ``regexp_extract_all`` the matches, and running lengths
give each start.

Defined cases: a null text is empty; null owners or repositories do not
count as one; documents equal in id and text have the same spans and come
out as often as they came in; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpipe.sources.io import materialize


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str          # Java regular expression
    group: int = 0        # the group that holds the value
    least: int = 1        # code points that the value needs
    base: bool = False


#: Kinds in the order that breaks ties between spans of equal start.
KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Kind("vcs", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Kind("login", r"://[^/\s:@]{1,64}:([^/\s:@]{3,64})@", 1),
    Kind("bearer", r"[Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,})", 1),
)


def _matches(text: Column, number: int, kind: Kind) -> Column:
    """Array of (kind, i, gap, len, value): every match with the length of the text before it."""
    parts = F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("values"))
    # A one-element array binds the three results, so each is computed once.
    rows = F.transform(F.array(parts), lambda p: F.transform(p["found"], lambda m, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), F.length(F.get(p["gaps"], i)).alias("gap"),
        F.length(m).alias("len"), F.get(p["values"], i).alias("value"))))
    return F.when(text.rlike(kind.pattern), F.get(rows, F.lit(0)))


def _row_key(id_col: str, text: Column) -> list[Column]:
    return [F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash")]


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                    repo_col: str | None = None, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(id, text_hash, kind, start, end, value_hash, owner, repo) for every match long
    enough; code points, end exclusive; ``kind`` is the place in ``kinds``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,value:string>>")
    found = F.concat(*[F.coalesce(_matches(text, n, k), none) for n, k in enumerate(kinds)])
    repo = F.lit(None).cast("string") if repo_col is None else F.col(repo_col)
    rows = (docs.select(*_row_key(id_col, text), F.col(owner_col).alias("owner"), repo.alias("repo"),
                        F.explode(found).alias("m"))
            .select("id", "text_hash", "owner", "repo", "m.*").distinct())
    so_far = Window.partitionBy("id", "text_hash", "owner", "repo", "kind").orderBy("i")
    least = F.element_at(F.array(*[F.lit(k.least) for k in kinds]), F.col("kind") + 1)
    return (rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
            .where(F.length("value") >= least)
            .select("id", "text_hash", "kind", (F.col("end") - F.col("len")).alias("start"), "end",
                    F.sha2(F.col("value").cast("binary"), 256).alias("value_hash"), "owner", "repo"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repos): distinct owners and repositories of each value."""
    owners = candidates.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count("owner").alias("n_owners"))
    repos = candidates.select("value_hash", "repo").distinct().groupBy("value_hash").agg(F.count("repo").alias("n_repos"))
    return owners.join(repos, "value_hash")


def classify(docs: DataFrame, max_owners: int = 3, max_repos: int = 20, **columns) -> DataFrame:
    """The candidates of ``docs`` with n_owners, n_repos and ``live``."""
    found = materialize(find_candidates(docs, **columns), "candidates")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    return found.join(ownership(found), "value_hash").withColumn("live", live)


def scan(docs: DataFrame, max_owners: int = 3, max_repos: int = 20, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str | None = None, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """A row for each document: id, one count for each base kind (``n_<kind>``), base_spans,
    spans (texts ``kind:start:end``, by start and then kind, comma-joined),
    n_live and n_example (different values of each sort)."""
    got = classify(docs, max_owners, max_repos, id_col=id_col, text_col=text_col, owner_col=owner_col,
                   repo_col=repo_col, kinds=kinds)
    base = F.element_at(F.array(*[F.lit(k.base) for k in kinds]), F.col("kind") + 1)
    spans = got.select("id", "text_hash", "kind", "start", "end", "live", "value_hash", base.alias("base")).distinct()
    entry = F.struct("start", "kind", "end")
    per_doc = spans.groupBy("id", "text_hash").agg(
        F.collect_list(F.when(F.col("base"), entry)).alias("base_spans"),
        F.collect_list(F.when(F.col("base") | F.col("live"), entry)).alias("spans"),
        F.size(F.collect_set(F.when(F.col("live"), F.col("value_hash")))).alias("n_live"),
        F.size(F.collect_set(F.when(~F.col("live"), F.col("value_hash")))).alias("n_example"),
        *[F.sum((F.col("kind") == n).cast("long")).alias(f"n_{k.name}") for n, k in enumerate(kinds) if k.base])

    names = F.array(*[F.lit(k.name) for k in kinds])

    def joined(col: str) -> Column:
        return F.array_join(F.transform(F.sort_array(col), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    rows = docs.select(*_row_key(id_col, F.coalesce(F.col(text_col), F.lit(""))))
    keys = rows["id"].eqNullSafe(per_doc["id"]) & (rows["text_hash"] == per_doc["text_hash"])
    zero = F.lit(0).cast("long")
    return rows.join(per_doc, keys, "left").select(
        rows["id"], *[F.coalesce(F.col(f"n_{k.name}"), zero).alias(f"n_{k.name}") for k in kinds if k.base],
        F.coalesce(joined("base_spans"), F.lit("")).alias("base_spans"),
        F.coalesce(joined("spans"), F.lit("")).alias("spans"),
        F.coalesce(F.col("n_live").cast("long"), zero).alias("n_live"),
        F.coalesce(F.col("n_example").cast("long"), zero).alias("n_example"))


def drop_live(docs: DataFrame, max_owners: int = 3, max_repos: int = 20, **columns) -> DataFrame:
    """``docs`` without those that hold a value that looks live."""
    got = classify(docs, max_owners, max_repos, **columns)
    text = F.coalesce(F.col(columns.get("text_col", "text")), F.lit(""))
    bad = got.where("live").select(F.col("id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct()
    same = docs[columns.get("id_col", "doc_id")].eqNullSafe(bad["__bad_id"]) & (F.xxhash64(text) == bad["__bad_hash"])
    return docs.join(bad, same, "left_anti")
