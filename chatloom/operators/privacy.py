"""Pseudonyms, exemptions, scans and masks over tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom import fixed
from chatloom.functions import patterns, text
from chatloom.operators.ranking import running_number
from chatloom.settings import DEFAULTS, NamePolicy

WORD = r"(?U)[\w-]+"
_NEVER = datetime(9999, 1, 1)


def first_seen(messages: DataFrame, keys: list[str]) -> DataFrame:
    """When each person first appears in each period; combined before the shuffle."""
    return (
        messages.filter(F.col("nickname").isNotNull() & ~F.coalesce("is_system", F.lit(False)))
        .groupBy(*keys, "nickname").agg(F.min("ts").alias("first_ts"))
    )


def public_name_exemption(nicknames: DataFrame, public_names: DataFrame) -> DataFrame:
    """``display`` of people who agreed to be named, matched on the exact nickname."""
    return nicknames.join(public_names.select("nickname", "display"), "nickname", "left")


def pseudonym_map(messages: DataFrame, public_names: DataFrame, keys: list[str]) -> DataFrame:
    """Pseudonym per nickname and period, in order of first appearance; people without a dated message come last.

    The map is a lazy frame: it is recomputed wherever it is used and no job
    writes it.
    """
    people = public_name_exemption(first_seen(messages, keys), public_names)
    named = people.filter(F.col("display").isNotNull()).select(
        *keys, "nickname", F.col("display").alias("pseudonym")
    )
    numbered = running_number(
        people.filter(F.col("display").isNull()).drop("display"),
        keys, F.coalesce(F.date_trunc("minute", "first_ts"), F.lit(_NEVER)), [F.asc_nulls_last("first_ts"), "nickname"], "n",
    )
    hidden = numbered.select(
        *keys, "nickname",
        F.concat(F.lit(fixed.PSEUDONYM_PREFIX), text.pseudonym_label(F.col("n") - 1)).alias("pseudonym"),
    )
    return named.unionByName(hidden)


def resolve_pseudonym(mapping: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Nicknames behind the wanted pseudonyms; unknown ones give no row."""
    return wanted.join(mapping, [*keys, "pseudonym"])


def resolve_nickname(mapping: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(mapping, [*keys, "nickname"])


_HANGUL = "가-힣"
_ENDINGS = "(?:" + "|".join(sorted((*fixed.PARTICLES, *fixed.NAME_ENDINGS), key=len, reverse=True)) + ")"


#: Three endings follow a name at most.
_LONGEST_TAIL = 3 * max(map(len, (*fixed.PARTICLES, *fixed.NAME_ENDINGS)))


def candidate_words(col: Column) -> Column:
    """Words of a text, as they stand and without what could be endings: Hangul words, by up to three endings' length.

    Whether known endings make up the rest is tested only where a name has been found.
    """
    words = F.array_distinct(F.regexp_extract_all(col, F.lit(WORD), F.lit(0)))

    def forms(word: Column) -> Column:
        heads = F.sequence(F.greatest(F.lit(1), F.length(word) - _LONGEST_TAIL), F.length(word))
        return F.when(
            F.substring(word, -1, 1).between("가", "힣"), F.transform(heads, lambda n: F.substr(word, F.lit(1), n))).otherwise(F.array(word))

    return F.filter(F.array_distinct(F.flatten(F.transform(words, forms))), lambda w: w != "")


def apply_pseudonyms(
    rows: DataFrame, mapping: DataFrame, keys: list[str], id_col: str, text_col: str
) -> DataFrame:
    """Replace nicknames in running text; the longest name goes first.

    A name is looked for where its first word occurs in the text, found by an
    equi-join of words, so that no row meets the whole list of names of its
    room.  Only names without a word character, where a room has any, meet all
    texts of the room.  Every whole occurrence is then replaced: one that no other
    letter of a word precedes and only known endings follow, so that a longer name
    with the nickname in it stays.
    """
    roster = mapping.select(*keys, "nickname", "pseudonym").filter("nickname <> ''").withColumn(
        "word", F.regexp_extract("nickname", WORD, 0)
    )
    words = rows.select(*keys, id_col, F.explode(candidate_words(F.col(text_col))).alias("word"))
    # sizes on disk tell nothing of words and names made from them: joined by a merge, no side passes through the driver
    by_word = words.join(roster.filter("word <> ''").hint("merge"), [*keys, "word"]).drop("word")
    by_room = rows.select(*keys, id_col).join(roster.filter("word = ''").drop("word").hint("merge"), keys)
    found = (
        by_word.unionByName(by_room)
        .groupBy(*keys, id_col)
        .agg(F.sort_array(F.collect_set(
            F.struct((-F.length("nickname")).alias("order"), "nickname", "pseudonym")
        )).alias("names"))
    )

    def swap(acc: Column, name: Column) -> Column:
        nickname = name["nickname"]
        # next to a Hangul letter of a name, Hangul goes on with the word: it must be a known ending
        before = F.when(F.substring(nickname, 1, 1).between("가", "힣"), F.lit(rf"(?<![A-Za-z0-9_{_HANGUL}])")).otherwise(F.lit(r"(?<![A-Za-z0-9_])"))
        after = F.when(
            F.substring(nickname, -1, 1).between("가", "힣"), F.lit(rf"(?={_ENDINGS}{{0,3}}(?![A-Za-z0-9_{_HANGUL}]))")).otherwise(F.lit(r"(?![A-Za-z0-9_])"))
        quoted = F.concat(before, F.lit(r"\Q"), F.replace(nickname, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"), after)
        return F.regexp_replace(acc, quoted, name["pseudonym"])

    return (
        rows.join(found.hint("merge"), [*keys, id_col], "left")
        .withColumn(text_col, F.when(
            F.col("names").isNotNull(), F.aggregate("names", F.col(text_col), swap)
        ).otherwise(F.col(text_col)))
        .drop("names")
    )


def apply_owner_pseudonyms(items: DataFrame, mapping: DataFrame, keys: list[str], owner: str) -> DataFrame:
    """Owner nickname → pseudonym by an equi-join; an unknown owner is dropped to NULL."""
    looked_up = mapping.select(*keys, F.col("nickname").alias(owner), F.col("pseudonym").alias("_p"))
    return items.join(looked_up, [*keys, owner], "left").withColumn(owner, F.col("_p")).drop("_p")


def _violations(rows: DataFrame, id_col: str, text_cols: list[str], kinds, rule: str) -> DataFrame:
    """One row per column and kind found.

    The kinds are their own projection below the generator, where common parts
    of the patterns are computed once; the outer generator keeps the optimizer
    from adding a filter that would scan a second time.
    """
    texts = F.array(*[F.struct(F.lit(c).alias("location"), F.col(c).alias("text")) for c in text_cols])
    if len(text_cols) == 1:
        long = rows.select(id_col, F.lit(text_cols[0]).alias("location"), F.col(text_cols[0]).alias("text"))
    else:
        long = rows.select(id_col, F.inline(texts))
    found = long.select(id_col, "location", kinds(F.col("text")).alias("kinds"))
    return found.select(
        id_col, "location", F.lit(rule).alias("rule"), F.explode_outer("kinds").alias("detail")
    ).filter(F.col("detail").isNotNull())


def scan_pii(rows: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    return _violations(rows, id_col, text_cols, patterns.pii_kinds, "pii")


def scan_local_paths(rows: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    return _violations(rows, id_col, text_cols, patterns.path_kinds, "local_path")


def scan_person_names(
    rows: DataFrame, id_col: str, text_cols: list[str], policy: NamePolicy = DEFAULTS.policy
) -> DataFrame:
    """Only in anon mode: texts that address a person by an honorific."""
    if policy.mode != "anon":
        return _violations(rows.filter(F.lit(False)), id_col, text_cols, patterns.pii_kinds, "person_name")

    def kinds(c: Column) -> Column:
        return F.when(patterns.names_person(c, policy), F.array(F.lit("honorific")))

    return _violations(rows, id_col, text_cols, kinds, "person_name")


def mask_texts(rows: DataFrame, text_cols: list[str]) -> DataFrame:
    return rows.withColumns({c: text.mask_pii(F.col(c)) for c in text_cols})
