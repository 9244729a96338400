"""Matching profiles and raw files to a station logbook. Every match is an equi-join; no pair is tested twice."""

from pyspark.sql import functions as F

from fathomline.functions.text import base_name, directory, walk_order
from fathomline.storage import save_stage

# Letters of the groups that the file-name index holds: long enough that a number in a name tells files apart.
GRAM = 8
# Wanted texts up to which they are broadcast to the file names (some 100 bytes each); above it both sides are shuffled.
BROADCAST_ASKS = 500_000


def logbook_exact(profiles, entries, order="entry_no"):
    """Profile path -> first logbook row whose ``ctd_file`` is the profile's file name."""
    names = profiles.select("path", base_name(F.col("path")).alias("profile_name"))
    first = entries.where("ctd_file IS NOT NULL").groupBy("ctd_file").agg(F.min(order).alias(order))
    chosen = entries.join(first, ["ctd_file", order], "left_semi")
    return names.join(chosen, names["profile_name"] == chosen["ctd_file"])


def logbook_prefix(profiles, entries, order="entry_no"):
    """Logbook row -> first profile (in walk order) that equals ``ctd_file`` or whose name, less its last ``_`` part, starts it.

    Each entry lists the prefixes of its own file name (as many as it has letters) and meets the profiles on equal text;
    the profiles are reduced to the first one per text before that, so a text many profiles share stays one row.
    """
    named = profiles.select(F.struct(walk_order(directory(F.col("path"))).alias("folder"), base_name(F.col("path")).alias("name"),
                                     "path").alias("place"), base_name(F.col("path")).alias("_name"))
    base = F.regexp_replace("_name", r"_?[^_]*$", "")
    keys = named.select("place", F.explode(F.array(
        F.struct(F.lit("whole").alias("way"), F.col("_name").alias("text")),
        F.struct(F.lit("start").alias("way"), base.alias("text")))).alias("k")).select("place", "k.*")
    firsts = keys.where("text <> ''").groupBy("way", "text").agg(F.min("place").alias("place"))
    name = F.col("ctd_file")
    starts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))), lambda n: F.struct(
        F.lit("start").alias("way"), F.substring(name, F.lit(1), n).alias("text")))
    wanted = entries.where("ctd_file IS NOT NULL").select(order, F.explode(F.concat(
        F.array(F.struct(F.lit("whole").alias("way"), name.alias("text"))), starts)).alias("k")).select(order, "k.*")
    # Unfolded lists are larger than the planner thinks, so it is kept from broadcasting them.
    best = wanted.join(firsts.hint("merge"), ["way", "text"]).groupBy(order).agg(F.min("place")["path"].alias("path"))
    return entries.join(best.hint("merge"), order)


def unmatched_profiles(profiles, matches):
    """Profiles no entry uses."""
    return profiles.select("path").join(matches.select("path"), "path", "left_anti")


def unmatched_entries(entries, matches, order="entry_no"):
    """Entries that name a file but found no profile, and entries that name none (``reason`` tells which)."""
    return entries.join(matches.select(order), order, "left_anti").withColumn(
        "reason", F.when(F.col("ctd_file").isNull(), "no file named").otherwise("no profile found"))


def match_summary(profiles, matches):
    """One row: profiles matched (each counted once) and profiles in all."""
    used = matches.select("path", F.lit(1).alias("_used")).distinct()
    return profiles.join(used, "path", "left").agg(
        F.count("_used").alias("matched_profiles"), F.count("*").alias("total_profiles"))


def grams(text, sizes):
    """Hashes of the substrings of a text that have one of the ``sizes`` (an array), each once."""
    return F.array_distinct(F.flatten(F.transform(sizes, lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda at: F.xxhash64(F.substring(text, at, n))))))


def related_files(entries, files, order="entry_no",
                  columns=("subocean_file", "exo_file", "exo_file_2")):
    """``(entry, kind, path)`` of the raw files an entry names.

    Folders in walk order; within one, the exact name, then the name in any case, then a name that contains the wanted
    text; the first hit wins. A SubOcean hit gives the ``.log`` and the ``.txt`` path.

    "Contains" goes through an index of letter groups: a wanted text asks with the one of its groups that the fewest files
    have, and what it meets is verified. The index has groups of ``GRAM`` letters, and shorter ones only of the lengths that
    shorter texts have. The other names meet on equal lower-case text. The joins are hinted, as the planner does not see how
    many rows the lists of groups and names unfold to: never are the files, or an index of them, broadcast. Hits are reduced
    to the first per wanted text before they are shuffled.
    """
    wanted = entries.select(order, F.explode(F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).alias("text")) for c in columns])).alias("k")).select(
        order, "k.*").where("text IS NOT NULL AND text <> ''")
    asks = save_stage(wanted.select(F.col("text").alias("ask")).distinct(), "asks")
    few = asks.count() <= BROADCAST_ASKS
    # A list of files may come from one small file, while its index is long: it is dealt over all cores first.
    spread = 4 * files.sparkSession.sparkContext.defaultParallelism
    named = files.select("path").repartition(spread, "path").select(
        "path", base_name(F.col("path")).alias("name"), walk_order(directory(F.col("path"))).alias("folder"))

    def met(asking):
        return F.broadcast(asking) if few else asking.hint("merge")

    # A text of GRAM letters or more asks with groups of that length, a shorter one with itself.
    own = F.least(F.length("ask"), F.lit(GRAM))
    asked = asks.select("ask", F.explode(grams(F.col("ask"), F.array(own))).alias("gram"))
    sizes = asks.agg(F.collect_set(own).alias("sizes"))
    index = named.crossJoin(F.broadcast(sizes)).select("path", "name", "folder", F.explode(grams(F.col("name"), F.col("sizes"))).alias("gram"))
    shared = index.groupBy("gram").count()
    rarest = save_stage(asked.join(shared.hint("merge"), "gram", "left").groupBy("ask").agg(F.min_by("gram", F.struct(
        F.coalesce("count", F.lit(0)), "gram")).alias("gram")), "rarest")
    rank = F.when(F.col("name") == F.col("ask"), 0).when(F.lower("name") == F.lower("ask"), 1).otherwise(2)
    inside = index.join(met(rarest), "gram").where(F.contains("name", "ask"))
    alike = named.withColumn("_low", F.lower("name")).join(met(asks.withColumn("_low", F.lower("ask"))), "_low")
    columns_ = ["ask", "folder", "name", "path"]
    found = inside.select(*columns_).unionByName(alike.select(*columns_)).groupBy("ask").agg(
        F.min(F.struct("folder", rank.alias("rank"), "name", "path")).alias("hit"))
    hits = wanted.join(found.hint("merge"), wanted["text"] == found["ask"]).select(order, "kind", F.col("hit.path").alias("path"))
    subocean = F.col("kind") == "subocean_file"
    both = F.array(
        F.struct(F.lit("subocean_log").alias("kind"), F.replace("path", F.lit(".txt"), F.lit(".log")).alias("path")),
        F.struct(F.lit("subocean").alias("kind"), F.replace("path", F.lit(".log"), F.lit(".txt")).alias("path")))
    return hits.select(order, F.explode(F.when(subocean, both).otherwise(
        F.array(F.struct("kind", "path")))).alias("k")).select(order, "k.*")


def station_files(matches, related=None, order="entry_no"):
    """``(campaign, Station, file_name, kind, source, entry_no)``: the files of each station's folder.

    A matched profile and the raw files its entry names go to the folder of the entry. Where two sources have one name in
    one folder, the later entry's file stays, as later copies replace earlier ones.
    """
    place = matches.select(order, "campaign", "Station")
    profiles = matches.select(order, "campaign", "Station", F.lit("profile").alias("kind"), "path")
    whole = profiles if related is None else profiles.unionByName(related.join(place.hint("merge"), order).select(
        order, "campaign", "Station", "kind", "path"))
    named = whole.withColumn("file_name", base_name(F.col("path")))
    last = F.max_by(F.struct("kind", F.col("path").alias("source"), order), F.struct(F.col(order), F.col("kind") != "profile", "kind", "path"))
    return named.groupBy("campaign", "Station", "file_name").agg(last.alias("_last")).select(
        "campaign", "Station", "file_name", "_last.*")


def with_activity_log(scans, log):
    """Station metadata on scans: a left join; the log is small, and the planner broadcasts it by its size."""
    return scans.join(log, "Station", "left")
