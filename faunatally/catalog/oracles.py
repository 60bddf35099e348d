"""The same results stated in SQL, for checking the registered queries."""

from __future__ import annotations

PREFIX = """
WITH part_rank AS (
  SELECT p_partkey, p_name, p_size,
         CASE WHEN p_size <= 2 THEN 0 WHEN p_size <= 5 THEN 1 WHEN p_size <= 9 THEN 2
              WHEN p_size <= 17 THEN 3 WHEN p_size <= 27 THEN 4 ELSE 5 END AS r,
         CAST(floor(p_partkey / 60.0) AS BIGINT) AS c_id, CAST(floor(p_partkey / 15.0) AS BIGINT) AS o_id,
         CAST(floor(p_partkey / 5.0) AS BIGINT) AS f_id, CAST(floor(p_partkey / 2.0) AS BIGINT) AS g_id
  FROM part),
taxon AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 97 <> 96 THEN 'P' || (c_id % 12) END AS phylum,
         CASE WHEN r > 0 THEN 'C' || c_id END AS class,
         CASE WHEN r > 1 THEN 'O' || o_id END AS tax_order,
         CASE WHEN r > 2 THEN 'F' || f_id WHEN r = 2 THEN '' END AS family,
         CASE r WHEN 0 THEN 'P' || (c_id % 12) WHEN 1 THEN 'C' || c_id WHEN 2 THEN 'O' || o_id
                WHEN 3 THEN 'F' || f_id WHEN 4 THEN 'G' || g_id
                ELSE 'G' || g_id || ' ' || split_part(p_name, ' ', 2) END AS name,
         CASE r WHEN 0 THEN 'Phylum' WHEN 1 THEN 'CLASS' WHEN 2 THEN 'Order'
                WHEN 3 THEN 'Family' WHEN 4 THEN 'genus' ELSE 'Species' END AS taxonRank,
         p_size > 45 AS rare
  FROM part_rank),
lines AS (
  SELECT l.*, t.phylum, t.class, t.tax_order, t.family, t.taxonRank,
         CASE WHEN t.rare THEN t.name || ' s' || l.l_suppkey ELSE t.name END AS scientificName,
         CASE WHEN l_tax = 0 AND l_discount = 0 THEN NULL
              WHEN l_discount = 0.1 THEN 'X' || l_orderkey ELSE 'D' || l_orderkey END AS deployment
  FROM lineitem l LEFT JOIN taxon t ON t.p_partkey = l.l_partkey),
annotations AS (
  SELECT deployment, phylum, class, tax_order, family, scientificName, taxonRank,
         CASE WHEN l_tax = 0.08 AND l_linestatus = 'O' THEN split_part(scientificName, ' ', 1) || ' ' || l_linenumber
              WHEN l_tax = 0.08 THEN 'T' || l_linenumber END AS tentativeId,
         CASE l_returnflag WHEN 'A' THEN 'Attracted' WHEN 'R' THEN 'Not attracted' END AS attracted,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS individualCount,
         l_orderkey * 10 + l_linenumber AS row_key
  FROM lines),
field_log AS (
  SELECT CASE WHEN o_orderkey <> 0 THEN 'D' || o_orderkey END AS deployment,
         CASE WHEN o_custkey % 20 <> 0
              THEN floor(o_totalprice / 200) + CAST(o_orderkey % 2 AS DOUBLE) / 2 END AS depth_m,
         'L' || (o_custkey % 25) AS location,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Hard' WHEN '2-HIGH' THEN 'soft'
              WHEN '3-MEDIUM' THEN 'Hard/Soft' WHEN '4-NOT SPECIFIED' THEN 'Hard' END AS substrate_type
  FROM orders),
freq_exclusions AS (
  SELECT 'D' || o_orderkey AS deployment FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority IN ('2-HIGH', '3-MEDIUM')),
manual_exclusions AS (
  SELECT DISTINCT deployment, scientificName FROM lines
  WHERE (l_linestatus = 'O' AND l_tax = 0.07 AND l_linenumber <= 2)
     OR (l_tax = 0 AND l_discount = 0 AND l_linenumber = 1)),
merged AS (
  SELECT a.*, f.depth_m, f.location, f.substrate_type
  FROM annotations a LEFT JOIN field_log f ON f.deployment IS NOT DISTINCT FROM a.deployment),
kept AS (
  SELECT m.* FROM merged m
  WHERE NOT EXISTS (SELECT 1 FROM manual_exclusions e WHERE e.deployment IS NOT DISTINCT FROM m.deployment
                    AND e.scientificName IS NOT DISTINCT FROM m.scientificName)),
clean AS (
  SELECT k.*, NOT EXISTS (SELECT 1 FROM freq_exclusions e
                          WHERE e.deployment IS NOT DISTINCT FROM k.deployment) AS valid_for_freq
  FROM kept k)"""

META = """,
meta AS (SELECT DISTINCT deployment, depth_m, substrate_type, valid_for_freq FROM clean),
effort AS (SELECT count(*) AS n_valid FROM meta WHERE valid_for_freq)"""


def _refined(paths: str) -> str:
    return f""",
paths AS ({paths}),
refined AS (
  SELECT *, lower(taxonRank) AS rank_clean,
         coalesce((lower(taxonRank) = 'phylum' AND n_phylum > 1) OR (lower(taxonRank) = 'class' AND n_class > 1)
               OR (lower(taxonRank) = 'order' AND n_order > 1) OR (lower(taxonRank) = 'family' AND n_family > 1)
               OR (lower(taxonRank) = 'genus' AND n_genus > 1), FALSE) AS is_redundant
  FROM (SELECT *, count(*) OVER (PARTITION BY phylum) AS n_phylum, count(*) OVER (PARTITION BY class) AS n_class,
               count(*) OVER (PARTITION BY tax_order) AS n_order, count(*) OVER (PARTITION BY family) AS n_family,
               count(*) OVER (PARTITION BY first_word) AS n_genus
        FROM (SELECT *, nullif(regexp_extract(scientificName, '^[^ ]+'), '') AS first_word FROM paths)))"""


_BLANKED = """coalesce(phylum, '') AS phylum, coalesce(class, '') AS class, coalesce(tax_order, '') AS tax_order,
  coalesce(family, '') AS family, scientificName, taxonRank"""
REFINED = _refined(
    f"SELECT {_BLANKED} FROM (SELECT DISTINCT phylum, class, tax_order, family, scientificName, taxonRank FROM clean)"
)
REFINED_NORMALISED = _refined(f"SELECT DISTINCT {_BLANKED} FROM clean")

_TAXON = "phylum, class, tax_order, family, scientificName"


def _number(column: str) -> str:
    """At most 15 significant digits, without exponent or trailing zeros."""
    places = f"greatest(14 - CAST(floor(log10(abs({column}))) AS INTEGER), 1)"
    plain = f"regexp_replace(format('{{:.' || {places} || 'f}}', {column}), '\\.?0+$', '')"
    return f"CASE WHEN {column} = 0 THEN '0' ELSE {plain} END"


def _marked(name: str) -> str:
    return (
        f"CASE WHEN {name} LIKE '% %' THEN '*' || {name} || '*' "
        f"WHEN family <> '' AND {name} <> family THEN '*' || {name} || '* sp.' ELSE {name} END"
    )


def _percent(part: str, whole: str, digits: int) -> str:
    return f"round_even(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, {digits})"


_RANGES = f""",
spans AS (
  SELECT {_TAXON}, min(depth_m * SCALE) AS min_depth, max(depth_m * SCALE) AS max_depth FROM clean GROUP BY ALL),
ranges AS (
  SELECT *, CASE WHEN min_depth = max_depth THEN {_number("min_depth")}
                 WHEN min_depth <> max_depth THEN {_number("min_depth")} || ' - ' || {_number("max_depth")}
            END AS depth_range
  FROM spans)"""
RANGES = _RANGES.replace(" * SCALE", "")
RANGES_FINE = _RANGES.replace("SCALE", "0.1::DOUBLE")


def _attracted(extra: str = "0") -> str:
    frequency = _percent(
        f"(count(DISTINCT deployment) FILTER (WHERE valid_for_freq) + {extra})", "(SELECT n_valid FROM effort)", 0
    )
    return f""",
attracted_taxa AS (
  SELECT {_TAXON}, {frequency} AS freq, max(individualCount) AS top FROM clean
  WHERE attracted = 'Attracted' GROUP BY {_TAXON}),
metrics AS (SELECT {_TAXON}, {_number("freq")} AS freq_occ, CAST(top AS VARCHAR) AS max_n FROM attracted_taxa)"""


TENTATIVE = f""",
tentative AS (
  SELECT {_TAXON}, string_agg(marked, ', ' ORDER BY seen, marked) AS t_ids
  FROM (SELECT {_TAXON}, marked, min(row_key) AS seen
        FROM (SELECT *, {_marked("tentativeId")} AS marked FROM clean WHERE tentativeId IS NOT NULL)
        GROUP BY {_TAXON}, marked)
  GROUP BY {_TAXON})"""

_LISTING = f""",
listing AS (
  SELECT *, row_number() OVER (PARTITION BY {_TAXON} ORDER BY first_seen, marked) - 1 AS place
  FROM (SELECT {_TAXON}, marked, min(row_key) AS first_seen
        FROM (SELECT *, {_marked("tentativeId")} AS marked FROM clean WHERE tentativeId IS NOT NULL)
        GROUP BY {_TAXON}, marked))"""

_SAME_TAXON = " AND ".join(f"r.{c} IS NOT DISTINCT FROM j.{c}" for c in _TAXON.split(", "))

INVENTORY = (
    META
    + RANGES
    + _attracted()
    + TENTATIVE
    + f""",
keys(level, name, ordinal) AS (VALUES
  ('phylum', 'P3', 1), ('phylum', 'P1', 2), ('phylum', 'P0', 3), ('phylum', 'P2', 4), ('phylum', 'P5', 5),
  ('phylum', 'P4', 6), ('phylum', 'P7', 7), ('phylum', 'P6', 8), ('phylum', 'P9', 9), ('phylum', 'P8', 10),
  ('class', 'C3', 1), ('class', 'C0', 2), ('class', 'C1', 3),
  ('tax_order', 'O5', 1), ('tax_order', 'O2', 2), ('tax_order', 'O0', 3),
  ('family', 'F9', 1), ('family', 'F3', 2), ('family', 'F0', 3)),
joined AS (
  SELECT r.*, m.freq_occ, m.max_n, t.t_ids
  FROM ranges r LEFT JOIN metrics m ON {_SAME_TAXON.replace("j.", "m.")}
  LEFT JOIN tentative t ON {_SAME_TAXON.replace("j.", "t.")}
  WHERE coalesce(r.scientificName NOT IN ('C0', 'O1', 'F2'), TRUE)),
placed AS (
  SELECT j.*, kp.ordinal AS p_ord, kc.ordinal AS c_ord, ko.ordinal AS o_ord, kf.ordinal AS f_ord
  FROM joined j LEFT JOIN keys kp ON kp.level = 'phylum' AND kp.name = j.phylum
  LEFT JOIN keys kc ON kc.level = 'class' AND kc.name = j.class
  LEFT JOIN keys ko ON ko.level = 'tax_order' AND ko.name = j.tax_order
  LEFT JOIN keys kf ON kf.level = 'family' AND kf.name = j.family),
shown AS (
  SELECT CASE WHEN p_ord IS NULL THEN '' ELSE phylum END AS phylum, coalesce(class, '') AS class,
         coalesce(tax_order, '') AS tax_order, coalesce(family, '') AS family,
         coalesce(scientificName, '') AS taxon, coalesce(depth_range, '') AS depth_range,
         coalesce(freq_occ, '') AS freq_occ, coalesce(max_n, '') AS max_n, coalesce(t_ids, '') AS t_ids,
         coalesce(p_ord, 2147483647) AS phylum_pos,
         coalesce(c_ord, CASE WHEN class IS NULL THEN 2147483647 ELSE 2147483646 END) AS class_pos,
         coalesce(o_ord, CASE WHEN tax_order IS NULL THEN 2147483647 ELSE 2147483646 END) AS order_pos,
         coalesce(f_ord, CASE WHEN family IS NULL THEN 2147483647 ELSE 2147483646 END) AS family_pos
  FROM placed),
inventory AS (
  SELECT phylum, class, tax_order, family,
         {_marked("taxon")} || CASE WHEN t_ids <> '' THEN '<br>(Tentative: ' || t_ids || ')' ELSE '' END
           AS scientificName,
         depth_range, freq_occ, max_n, taxon, phylum_pos, class_pos, order_pos, family_pos
  FROM shown)"""
)

_ZONE = (
    "CASE WHEN depth_m < 700 THEN '<700 m' WHEN depth_m >= 700 AND depth_m <= 1500 THEN '700-1500 m' "
    "WHEN depth_m > 1500 THEN '>1500 m' END"
)
_ZONE_POS = "CASE depth_zone WHEN '<700 m' THEN 1 WHEN '700-1500 m' THEN 2 WHEN '>1500 m' THEN 3 END"

ZONES = (
    META
    + f""",
zones AS (
  SELECT depth_zone, {_ZONE_POS} AS zone_pos, count(*) AS total_zone_deps,
         count(*) FILTER (WHERE valid_for_freq) AS valid_zone_deps
  FROM (SELECT *, {_ZONE} AS depth_zone FROM meta) WHERE depth_zone IS NOT NULL GROUP BY depth_zone),
zoned AS (
  SELECT c.*, z.zone_pos, z.total_zone_deps, z.valid_zone_deps,
         CASE WHEN phylum = 'P0' THEN 'Fish' WHEN phylum <> 'P0' THEN 'Invertebrate' END AS fauna_group
  FROM (SELECT *, {_ZONE} AS depth_zone FROM clean) c JOIN zones z ON z.depth_zone = c.depth_zone)"""
)


INVENTORY_FINE = INVENTORY.replace(RANGES, RANGES_FINE)


def _zone_top(group: str, name: str, with_null: bool = False) -> str:
    units = "count(DISTINCT deployment)"
    if with_null:
        units += " + max(CASE WHEN deployment IS NULL THEN 1 ELSE 0 END)"
    return (
        ZONES
        + f""",
counted AS (
  SELECT depth_zone, zone_pos, fauna_group, {group} AS {name}, CAST({units} AS BIGINT) AS occ,
         {_percent(f"({units})", "any_value(valid_zone_deps)", 1)} AS freq_occ
  FROM zoned WHERE {group} <> '' AND valid_for_freq GROUP BY depth_zone, zone_pos, fauna_group, {group}),
top AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY depth_zone, fauna_group
                                    ORDER BY freq_occ DESC, {name}) AS INTEGER) AS rank_pos
  FROM counted QUALIFY rank_pos <= 10)"""
    )


_GROUP = "CASE WHEN fauna_group = 'Fish' THEN family WHEN fauna_group <> 'Fish' THEN tax_order END"
ZONE_TAXA = _zone_top("scientificName", "scientificName")
ZONE_TAXA_WITH_NULL = _zone_top("scientificName", "scientificName", True)
ZONE_GROUPS = _zone_top(_GROUP, "taxa_group")
ZONE_GROUPS_WITH_NULL = _zone_top(_GROUP, "taxa_group", True)
# Both tables from the same zones, the second under other names.
BOTH_ZONE_TABLES = ZONE_TAXA_WITH_NULL + ZONE_GROUPS_WITH_NULL.removeprefix(ZONES).replace("counted", "counted_groups").replace(
    "top AS", "top_groups AS"
)


def _overlap(with_null: bool) -> str:
    def units(test: str) -> str:
        plain = f"count(DISTINCT deployment) FILTER (WHERE {test})"
        if not with_null:
            return plain
        return f"{plain} + max(CASE WHEN depth_m IS NULL OR (({test}) AND deployment IS NULL) THEN 1 ELSE 0 END)"

    return f""",
beyond AS (SELECT DISTINCT scientificName FROM clean WHERE depth_m > 1900 AND scientificName <> ''),
sides AS (
  SELECT phylum, family, scientificName, min(depth_m) AS min_depth, max(depth_m) AS max_depth,
         CAST({units("depth_m > 1900")} AS BIGINT) AS n_deep_deps,
         CAST({units("depth_m <= 1900")} AS BIGINT) AS n_shallow_deps
  FROM clean WHERE scientificName IN (SELECT scientificName FROM beyond) GROUP BY phylum, family, scientificName),
overlap AS (
  SELECT *, CASE WHEN n_shallow_deps = 0 THEN 'Exclusive to >1900m' ELSE 'Shared with Shallower Depths' END
              AS distribution
  FROM sides)"""


OVERLAP = _overlap(False)
OVERLAP_WITH_NULL = _overlap(True)


def _profile(place: str) -> str:
    return f"""
SELECT bin, CAST(bin * 100 AS DOUBLE) AS bin_from, CAST((bin + 1) * 100 AS DOUBLE) AS bin_to,
       CASE WHEN valid_for_freq THEN 'Full Deployment (All Metrics)'
            ELSE 'Partial Deployment (Presence/MaxN Only)' END AS effort_status,
       CASE WHEN valid_for_freq THEN 1 ELSE 2 END AS status_pos, count(*) AS n_deployments
FROM (SELECT CAST({place} AS BIGINT) AS bin, valid_for_freq FROM meta WHERE depth_m IS NOT NULL)
GROUP BY bin, valid_for_freq"""


def _frequency(group: str, test: str, extra: str = "0") -> str:
    share = _percent(f"(count(DISTINCT deployment) + {extra})", "(SELECT n_valid FROM effort)", 1)
    return (
        f"\nSELECT {group}, {share} AS freq_occ FROM clean "
        f"WHERE phylum {test} 'P0' AND {group} <> '' AND valid_for_freq GROUP BY {group}"
    )


def _top_max_n(test: str) -> str:
    return (
        "\nSELECT scientificName, max(individualCount) AS max_n FROM clean "
        f"WHERE individualCount IS NOT NULL AND phylum {test} 'P0' "
        "GROUP BY scientificName ORDER BY max_n DESC, scientificName LIMIT 10"
    )


_RICHNESS = """
SELECT count(*) AS total_taxa, count(*) FILTER (WHERE phylum = 'P0') AS phylum_taxa,
       count(*) FILTER (WHERE phylum <> 'P0') AS other_taxa
FROM refined WHERE NOT is_redundant"""

_SUMMARY = """
SELECT count(*) AS total_deployments, count(*) FILTER (WHERE valid_for_freq) AS valid_deployments,
       round_even(avg(depth_m), 1) AS mean_depth, round_even(stddev_samp(depth_m), 1) AS sd_depth,
       min(depth_m) AS min_depth, max(depth_m) AS max_depth,
       count(*) FILTER (WHERE lower(substrate_type) LIKE '%soft%') AS n_soft,
       count(*) FILTER (WHERE lower(substrate_type) LIKE '%hard%') AS n_hard
FROM meta"""

_AUDIT = """
SELECT (SELECT count(*) FROM merged) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
       (SELECT count(*) FROM merged) - (SELECT count(*) FROM kept) AS rows_dropped"""

# A field log with a second, deeper entry for the deployments of two places.
REPEATED = PREFIX.replace(
    """
  FROM orders),
freq_exclusions""",
    """
  FROM orders),
twice AS (
  SELECT * FROM field_log
  UNION ALL SELECT deployment, depth_m + 100, location, substrate_type FROM field_log WHERE location IN ('L3', 'L4')),
freq_exclusions""",
).replace("LEFT JOIN field_log f", "LEFT JOIN twice f")

# Columns of the sheet that the model does not know.
ALL_COLUMNS = PREFIX.replace(
    "l_orderkey * 10 + l_linenumber AS row_key",
    'l_orderkey * 10 + l_linenumber AS row_key, l_suppkey AS observer, l_linestatus AS "Notes (free)",\n'
    "         l_returnflag AS location_annotated",
)

_NULL_UNIT = "max(CASE WHEN deployment IS NULL THEN 1 ELSE 0 END)"

ORACLES: dict[str, str] = {
    "merge_field_log": PREFIX + "\nSELECT * FROM merged",
    "apply_exclusions": PREFIX
    + """
SELECT a.* FROM annotations a
WHERE NOT EXISTS (SELECT 1 FROM manual_exclusions e WHERE e.deployment IS NOT DISTINCT FROM a.deployment
                  AND e.scientificName IS NOT DISTINCT FROM a.scientificName)""",
    "exclusion_audit": PREFIX + _AUDIT,
    "exclusion_audit_of_repeats": REPEATED + _AUDIT,
    "written_counts": REPEATED + _AUDIT,
    "written_exclusions": REPEATED
    + """
SELECT m.*, NOT EXISTS (SELECT 1 FROM freq_exclusions e
                        WHERE e.deployment IS NOT DISTINCT FROM m.deployment) AS valid_for_freq
FROM merged m WHERE EXISTS (SELECT 1 FROM manual_exclusions e WHERE e.deployment IS NOT DISTINCT FROM m.deployment
                            AND e.scientificName IS NOT DISTINCT FROM m.scientificName)""",
    "merge_unique_log": PREFIX + "\nSELECT * FROM merged",
    "flag_effort_without_list": PREFIX + "\nSELECT *, TRUE AS valid_for_freq FROM annotations",
    "flag_effort": PREFIX
    + """
SELECT a.*, NOT EXISTS (SELECT 1 FROM freq_exclusions e
                        WHERE e.deployment IS NOT DISTINCT FROM a.deployment) AS valid_for_freq
FROM annotations a""",
    "effort_audit": PREFIX + "\nSELECT count(*) AS listed_rows FROM freq_exclusions",
    "clean_table": PREFIX + "\nSELECT * FROM clean",
    "clean_table_all_columns": ALL_COLUMNS + "\nSELECT * FROM clean",
    "clean_table_written": ALL_COLUMNS + "\nSELECT * FROM clean",
    "annotations_from_csv": PREFIX + "\nSELECT * REPLACE (nullif(family, '') AS family) FROM annotations",
    "field_log_from_csv": PREFIX + "\nSELECT * FROM field_log",
    "listed_deployments": PREFIX + "\nSELECT * FROM freq_exclusions",
    "refine_taxa": PREFIX + REFINED + "\nSELECT * FROM refined",
    "refine_taxa_normalised": PREFIX + REFINED_NORMALISED + "\nSELECT * FROM refined",
    "true_richness": PREFIX + REFINED + f"\nSELECT {_TAXON}, taxonRank FROM refined WHERE NOT is_redundant",
    "richness_counts": PREFIX + REFINED + _RICHNESS,
    "redundancy_audit": PREFIX
    + REFINED
    + "\nSELECT scientificName, family, taxonRank FROM refined WHERE is_redundant",
    "class_richness": PREFIX
    + REFINED
    + "\nSELECT count(*) AS n_taxa FROM refined WHERE NOT is_redundant AND class IN ('C0', 'C12')",
    "deploy_meta": PREFIX + META + "\nSELECT * FROM meta",
    "sampling_summary": PREFIX + META + _SUMMARY,
    "depth_profile": PREFIX
    + META
    + _profile("least(floor(depth_m / 100), greatest((SELECT ceil(max(depth_m) / 100) FROM meta) - 1, 0))"),
    "depth_profile_right_closed": PREFIX + META + _profile("greatest(ceil(depth_m / 100) - 1, 0)"),
    "axis_bound": PREFIX + META + "\nSELECT ceil(max(depth_m) / 100) * 100 AS axis_bound FROM meta",
    "compact_sightings": PREFIX
    + f"""
SELECT deployment, depth_m, substrate_type, valid_for_freq, {_TAXON}, taxonRank, attracted,
       max(individualCount) AS individualCount
FROM clean GROUP BY ALL""",
    "depth_ranges": PREFIX + RANGES + "\nSELECT * FROM ranges",
    "depth_ranges_fine": PREFIX + RANGES_FINE + "\nSELECT * FROM ranges",
    "attracted_metrics": PREFIX + META + _attracted() + "\nSELECT * FROM metrics",
    "taxon_measures": PREFIX
    + META
    + RANGES
    + _attracted()
    + f"""
SELECT r.*, m.freq_occ, m.max_n FROM ranges r LEFT JOIN metrics m ON {_SAME_TAXON.replace("j.", "m.")}""",
    "attracted_metrics_with_null": PREFIX
    + META
    + _attracted("max(CASE WHEN valid_for_freq AND deployment IS NULL THEN 1 ELSE 0 END)")
    + "\nSELECT * FROM metrics",
    "tentative_listing": PREFIX + _LISTING + "\nSELECT * FROM listing",
    "tentative_pieces": PREFIX
    + _LISTING
    + f"""
SELECT {_TAXON}, place // 2 AS piece, string_agg(marked, ', ' ORDER BY place) AS text
FROM listing GROUP BY {_TAXON}, place // 2""",
    "tentative_ids": PREFIX + TENTATIVE + "\nSELECT * FROM tentative",
    "taxon_inventory": PREFIX + INVENTORY + "\nSELECT * FROM inventory",
    "inventory_from_sets": PREFIX + INVENTORY + "\nSELECT * FROM inventory",
    "taxon_inventory_fine": PREFIX + INVENTORY_FINE + "\nSELECT * FROM inventory",
    "inventory_labels": PREFIX
    + INVENTORY
    + """
SELECT phylum AS "Phylum", class AS "Class", tax_order AS "Order", family AS "Family",
       scientificName AS "Lowest Taxonomic ID", depth_range AS "Depth (m)", freq_occ AS "Freq. of Occ. (%)",
       max_n AS "MaxN"
FROM inventory""",
    "families_excluding": PREFIX
    + """
SELECT count(DISTINCT family) AS n_families FROM clean
WHERE phylum = 'P0' AND coalesce(class NOT IN ('C0', 'C24'), TRUE) AND family <> ''""",
    "distinct_phyla": PREFIX + "\nSELECT count(DISTINCT phylum) AS n_phyla FROM clean",
    "distinct_phyla_with_null": PREFIX + "\nSELECT count(*) AS n_phyla FROM (SELECT DISTINCT phylum FROM clean)",
    "family_count": PREFIX
    + "\nSELECT count(DISTINCT family) AS n_families FROM clean WHERE phylum = 'P0' AND family <> ''",
    "order_count": PREFIX
    + "\nSELECT count(DISTINCT tax_order) AS n_groups FROM clean WHERE phylum <> 'P0' AND tax_order <> ''",
    "family_frequency": PREFIX + META + _frequency("family", "="),
    "family_frequency_with_null": PREFIX + META + _frequency("family", "=", _NULL_UNIT),
    "order_frequency": PREFIX + META + _frequency("tax_order", "<>"),
    "order_frequency_with_null": PREFIX + META + _frequency("tax_order", "<>", _NULL_UNIT),
    "top_maxn_in": PREFIX + _top_max_n("="),
    "top_maxn_out": PREFIX + _top_max_n("<>"),
    "zone_effort": PREFIX + ZONES + "\nSELECT * FROM zones",
    "zone_enriched": PREFIX + ZONES + "\nSELECT * FROM zoned",
    "zone_taxa_top10": PREFIX + ZONE_TAXA + "\nSELECT * FROM top",
    "zone_groups_top10": PREFIX + ZONE_GROUPS + "\nSELECT * FROM top",
    "zone_taxa_with_null": PREFIX + ZONE_TAXA_WITH_NULL + "\nSELECT * FROM top",
    "zone_groups_with_null": PREFIX + ZONE_GROUPS_WITH_NULL + "\nSELECT * FROM top",
    "frequencies_from_sets": PREFIX
    + BOTH_ZONE_TABLES
    + f"""
SELECT 'family' AS kind, NULL::VARCHAR AS depth_zone, NULL::VARCHAR AS fauna_group, family AS taxon, NULL::BIGINT AS occ, freq_occ
FROM ({_frequency("family", "=", _NULL_UNIT)})
UNION ALL SELECT 'order', NULL, NULL, tax_order, NULL, freq_occ FROM ({_frequency("tax_order", "<>", _NULL_UNIT)})
UNION ALL SELECT 'zone taxon', depth_zone, fauna_group, scientificName, occ, freq_occ FROM top
UNION ALL SELECT 'zone group', depth_zone, fauna_group, taxa_group, occ, freq_occ FROM top_groups""",
    "zone_fish": PREFIX + ZONE_TAXA + "\nSELECT * EXCLUDE (fauna_group) FROM top WHERE fauna_group = 'Fish'",
    "zone_inverts": PREFIX
    + ZONE_TAXA
    + "\nSELECT * EXCLUDE (fauna_group) FROM top WHERE fauna_group = 'Invertebrate'",
    "zone_fish_families": PREFIX
    + ZONE_GROUPS
    + "\nSELECT * EXCLUDE (fauna_group) FROM top WHERE fauna_group = 'Fish'",
    "zone_invert_orders": PREFIX
    + ZONE_GROUPS
    + "\nSELECT * EXCLUDE (fauna_group) FROM top WHERE fauna_group = 'Invertebrate'",
    "taxa_beyond": PREFIX + OVERLAP + "\nSELECT * FROM beyond",
    "threshold_overlap": PREFIX + OVERLAP + "\nSELECT * FROM overlap",
    "threshold_overlap_with_null": PREFIX + OVERLAP_WITH_NULL + "\nSELECT * FROM overlap",
    "threshold_overlap_of_names": PREFIX + OVERLAP + "\nSELECT * FROM overlap",
    "overlap_from_sets": PREFIX + OVERLAP_WITH_NULL + "\nSELECT * FROM overlap",
    "exclusive_taxa": PREFIX
    + OVERLAP
    + """
SELECT family, scientificName, n_deep_deps, min_depth, max_depth FROM overlap
WHERE distribution = 'Exclusive to >1900m'""",
    "shared_taxa": PREFIX
    + OVERLAP
    + """
SELECT family, scientificName, n_deep_deps, n_shallow_deps, min_depth, max_depth FROM overlap
WHERE distribution = 'Shared with Shallower Depths'""",
    "report_metrics": PREFIX
    + META
    + REFINED
    + f"""
, summary AS ({_SUMMARY}), richness AS ({_RICHNESS}),
figures AS (
  SELECT s.*, r.*, (SELECT count(DISTINCT phylum) FROM clean) AS n_phyla,
         (SELECT count(DISTINCT tax_order) FROM clean WHERE phylum <> 'P0' AND tax_order <> '') AS n_groups,
         (SELECT count(DISTINCT scientificName) FROM clean
          WHERE depth_m > 1900 AND scientificName <> '') AS taxa_beyond
  FROM summary s CROSS JOIN richness r)
SELECT metric, value FROM (
  SELECT unnest(['total_deployments', 'valid_deployments', 'mean_depth', 'sd_depth', 'min_depth', 'max_depth',
                 'n_soft', 'n_hard', 'total_taxa', 'phylum_taxa', 'other_taxa', 'n_phyla', 'n_groups',
                 'taxa_beyond']) AS metric,
         unnest([CAST(total_deployments AS DOUBLE), valid_deployments, mean_depth, sd_depth, min_depth, max_depth,
                 n_soft, n_hard, total_taxa, phylum_taxa, other_taxa, n_phyla, n_groups, taxa_beyond]) AS value
  FROM figures)""",
    "report_figures": PREFIX
    + META
    + REFINED
    + f"""
, summary AS ({_SUMMARY}), richness AS ({_RICHNESS}),
figures(metric, value) AS (
  SELECT unnest(['total_deployments', 'valid_deployments', 'mean_depth', 'sd_depth', 'min_depth', 'max_depth', 'n_soft',
                 'n_hard']),
         unnest([CAST(total_deployments AS DOUBLE), valid_deployments, mean_depth, sd_depth, min_depth, max_depth, n_soft,
                 n_hard]) FROM summary
  UNION ALL SELECT unnest(['total_taxa', 'phylum_taxa', 'other_taxa']), unnest([total_taxa, phylum_taxa, other_taxa]) FROM richness
  UNION ALL SELECT 'axis_bound', ceil(max(depth_m) / 100) * 100 FROM meta
  UNION ALL SELECT 'cartilaginous_taxa', count(*) FROM refined WHERE NOT is_redundant AND class IN ('C0', 'C12')
  UNION ALL SELECT 'bony_families', count(DISTINCT family) FROM clean
            WHERE phylum = 'P0' AND coalesce(class NOT IN ('C0', 'C24'), TRUE) AND family <> ''
  UNION ALL SELECT 'n_phyla', count(*) FROM (SELECT DISTINCT phylum FROM clean)
  UNION ALL SELECT 'phylum_families', count(DISTINCT family) FROM clean WHERE phylum = 'P0' AND family <> ''
  UNION ALL SELECT 'other_orders', count(DISTINCT tax_order) FROM clean WHERE phylum <> 'P0' AND tax_order <> ''
  UNION ALL SELECT 'taxa_beyond', count(DISTINCT scientificName) FROM clean WHERE depth_m > 1900 AND scientificName <> '')
SELECT metric, CAST(value AS DOUBLE) AS value FROM figures""",
}
