"""Secrets in texts, and how many owners and repositories a candidate is seen in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.session import lookup, written

#: Fixed patterns of the three base kinds; an assignment's value is group 2.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "owned")
LEAST_VALUE = 12
#: Further candidates: long runs of key characters with letters, digits and many different characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_DIFFERENT = 10
#: Values that documentation uses.
PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]|x{6}|0{8}|12345678"
#: Seen with so many owners or repositories, a value is a copied example.
OWNERS = 2
REPOSITORIES = 4


COUNTED = ("n_copied", "n_base_owned", "n_base_copied")


def _spans(found: Column, pieces: Column, kind: int) -> Column:
    """Spans of the matches ``found`` of a text that they cut into ``pieces``, in code points."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,kind:int,end:long>>").alias("out"))
    step = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))

    def one(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["p"]
        b = a + x["m"]
        return F.struct(b.alias("at"), F.array_append(acc["out"], F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"))).alias("out"))

    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return F.when(F.size(found) > 0, F.aggregate(step, start, one)["out"]).otherwise(none)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (spans of the three kinds by start, then kind), ``values`` and ``candidates``.

    A span is (start, kind, end), a value of a base span or a candidate (start, kind, end, token), where the token of
    an assignment is what is assigned; null is an empty text.
    Every pattern goes over the whole text once, and a second time where it has matched.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns(
        {
            "_m0": F.regexp_extract_all(body, F.lit(ASSIGN), 0),
            "_m1": F.regexp_extract_all(body, F.lit(ACCESS), 0),
            "_m2": F.regexp_extract_all(body, F.lit(HEX), 0),
            "_m3": F.regexp_extract_all(body, F.lit(CANDIDATE), 0),
        }
    )
    value = F.regexp_extract_all(body, F.lit(ASSIGN), 2)
    no_tokens = F.array().cast("array<struct<start:long,kind:int,end:long,token:string>>")

    def with_tokens(spans: Column, tokens: Column) -> Column:
        return F.zip_with(spans, tokens, lambda s, t: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), t.alias("token")))

    def plain(tokens: Column) -> Column:
        return F.transform(tokens, lambda v: F.struct(v["start"].alias("start"), v["kind"].alias("kind"), v["end"].alias("end")))

    assigned = F.filter(with_tokens(_spans(F.col("_m0"), F.split(body, ASSIGN, -1), 0), value), lambda v: F.length(v["token"]) >= LEAST_VALUE)
    found = found.withColumn("_v0", F.when(F.size("_m0") > 0, assigned).otherwise(no_tokens))
    found = found.withColumns(
        {
            "_s0": plain(F.col("_v0")),
            "_s1": _spans(F.col("_m1"), F.split(body, ACCESS, -1), 1),
            "_s2": _spans(F.col("_m2"), F.split(body, HEX, -1), 2),
            "_s3": _spans(F.col("_m3"), F.split(body, CANDIDATE, -1), 3),
        }
    )
    found = found.withColumn("base", F.array_sort(F.concat("_s0", "_s1", "_s2")))
    found = found.withColumn("values", F.concat("_v0", with_tokens(F.col("_s1"), F.col("_m1")), with_tokens(F.col("_s2"), F.col("_m2"))))

    def live(token: Column) -> Column:
        different = F.size(F.array_distinct(F.split(token, ""))) >= LEAST_DIFFERENT
        return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & different & ~token.rlike(PLACEHOLDER)

    pairs = with_tokens(F.col("_s3"), F.col("_m3"))
    apart = F.filter(pairs, lambda c: live(c["token"]) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return found.withColumn("candidates", apart).drop("_v0", *[f"_m{i}" for i in range(4)], *[f"_s{i}" for i in range(4)])


def ownership(candidates: DataFrame) -> DataFrame:
    """For each ``hash``: ``owners``, ``repositories`` and ``copies`` in the whole corpus.

    ``candidates`` has ``hash, owner, repository``.  Rows are counted before each shuffle, so a
    value copied into a third of all documents is one row for each task and repository; null
    owners count as one owner.
    """
    each = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("copies"))
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("copies").alias("copies"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("copies").alias("copies"))


def secret_spans(
    docs: DataFrame, owner: str = "source", repository: str = "lang", owners: int = OWNERS, repositories: int = REPOSITORIES
) -> DataFrame:
    """Secrets of every document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied,
    n_base_owned, n_base_copied``.

    Base spans come from the text alone.  Owners and repositories (an owner with its ``repository`` column; ``documents``
    has languages in its place) are counted for every value in the whole corpus, whether it stands bare, is assigned, or is an
    access key or a hex run.  A candidate apart from base spans is added (kind ``owned``) when it has fewer than
    ``owners`` owners and ``repositories`` repositories; others are copied examples and are only counted
    (``n_copied``).  Base spans are counted alike: ``n_base_owned`` have a value of few owners that is no
    placeholder, ``n_base_copied`` the rest.  Spans are in code points, end exclusive.

    Null and empty texts have no spans.  Repeated rows each get a row; rows are told apart by id
    and a hash of the text, so rows of one id with other texts keep their own spans.  Columns of
    other names are not looked at.
    """
    given = docs.select("doc_id", "text", F.col(owner).cast("string").alias("_owner"), F.col(repository).cast("string").alias("_repository"))
    found = base_spans(given).select("doc_id", F.xxhash64("text").alias("_key"), "_owner", "_repository", "base", F.concat("values", "candidates").alias("candidates"))
    found = written(found, "secret-spans")
    one = found.where(F.size("candidates") > 0).select(
        "doc_id", "_key", F.col("_owner").alias("owner"), F.struct("_owner", "_repository").alias("repository"), F.explode("candidates").alias("c")
    )
    one = one.withColumn("hash", F.sha2(F.col("c.token"), 256))
    seen = written(ownership(one.select("hash", "owner", "repository")), "ownership")
    alone = (F.col("owners") < owners) & (F.col("repositories") < repositories)
    # a value that one repository has in a third of all documents is met by many tasks
    judged = lookup(one, seen.where(alone).select("hash", F.lit(True).alias("_own")), ["hash"], spread="_key")
    own = F.coalesce("_own", F.lit(False)) & ((F.col("c.kind") == 3) | ~F.col("c.token").rlike(PLACEHOLDER))
    # a set of spans for each text, whatever number of equal rows there is
    judged = judged.withColumn("_own", own).groupBy("doc_id", "_key", "c.start", "c.kind", "c.end").agg(F.max("_own").alias("_own"))
    bare, owned = F.col("kind") == 3, F.col("_own")
    added = judged.groupBy("doc_id", "_key").agg(
        F.collect_list(F.when(bare & owned, F.struct("start", "kind", "end"))).alias("_added"),
        *[F.count(F.when(which, 1)).alias(name) for name, which in (("n_copied", bare & ~owned), ("n_base_owned", ~bare & owned), ("n_base_copied", ~bare & ~owned))],
    )
    added = added.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "_added", *COUNTED)
    plain = found.select("doc_id", "_key", "base")
    joined = plain.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left")
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    everything = F.array_sort(F.concat("base", F.coalesce("_added", none)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return joined.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(everything).alias("spans"),
        F.size(F.coalesce("_added", none)).cast("long").alias("n_owned"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in COUNTED],
    )
