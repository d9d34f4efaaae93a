"""Queries of the text, path, metadata and configuration operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..sources import files
from .trees import table


def xml_tag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.tag_text(F.col("html"), "title").alias("title"))


def xml_attr(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.tag_attribute(F.col("html"), "html", "lang").alias("lang"))


def xml_decode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.decode_entities(text.tag_text(F.col("html"), "title")).alias("title"))


def metadata_srs(spark, sf_dir):
    """Metadata documents made of customers, in element and attribute form."""
    k = F.col("c_custkey").cast("string")
    element = F.concat(F.lit('<ModelMetadata version="1.0"><SRS>EPSG:'), k, F.lit("</SRS><SRSOrigin>1,2,"), k, F.lit("</SRSOrigin></ModelMetadata>"))
    attribute = F.concat(F.lit('<ModelMetadata version="1.1" SRS="A &amp;amp; '), k, F.lit('" SRSOrigin="0,0,0"/>'))
    raw = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, element).otherwise(attribute).alias("value"))
    return files.metadata_columns(raw)


def config_json(spark, sf_dir):
    """Optional keys of a configuration: max_lvl present in some documents, unreadable ones give nulls."""
    body = F.when(F.col("event_id") % 5 == 0, F.lit("{broken")).otherwise(F.replace("props", F.lit('"k"'), F.lit('"max_lvl"')))
    return table(spark, sf_dir, "events").select("event_id", F.from_json(body, files.CONFIG).alias("c")).select("event_id", "c.x", "c.max_lvl")


def output_name(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    file = F.concat(F.lit("Tile_"), F.col("o_orderkey").cast("string"), F.lit(".osgb"))
    return o.select("o_orderkey", text.output_name(file, (F.col("o_orderkey") % 3).cast("int")).alias("name"))


def lod_level(spark, sf_dir):
    k = F.col("o_orderkey")
    file = F.concat(F.lit("a/b/T"), F.when(k % 3 == 0, F.concat(F.lit("_L"), (k % 30).cast("string"), F.lit("_0"))).when(k % 3 == 1, F.concat(F.lit("x"), (k % 100).cast("string"))).otherwise("y"), F.lit(".osgb"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.lod_level(file).alias("level"))


def path_parts(spark, sf_dir):
    """Base name and parent of URLs' paths, with back slashes in some."""
    url = F.when(F.col("page_id") % 3 == 0, F.replace("url", F.lit("/"), F.lit("\\"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", text.base_name(url).alias("base"), text.parent_path(url).alias("parent"))


def split_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.concat_ws("|", text.split_parts(F.col("url"), "/")).alias("parts"), F.size(text.split_parts(F.col("url"), "/")).alias("n"))


def replace_first(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.replace_first(F.col("url"), F.lit("e"), F.lit("<E>")).alias("url"))


def uri_prefix(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    uri = F.concat(F.lit("./"), F.col("o_orderkey").cast("string"), F.lit(".glb"))
    return o.select("o_orderkey", text.tile_uri(uri, F.concat(F.lit("T"), F.col("o_custkey").cast("string"))).alias("uri"))


def uri_rewrite(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    uri = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "./Data/").otherwise("Data/"), F.col("o_orderkey").cast("string"), F.lit(".glb"))
    return o.select("o_orderkey", text.sub_index_uri(uri).alias("uri"))


def crs_dispatch(spark, sf_dir):
    k = F.col("c_custkey")
    srs = F.when(k % 4 == 0, F.concat(F.lit("ENU:"), (k % 90).cast("string"), F.lit(","), (k % 180).cast("string"))).when(k % 4 == 1, F.concat(F.lit("EPSG:"), (k + 32600).cast("string"))).when(k % 4 == 2, F.lit('PROJCS["x"]')).otherwise("LOCAL:1")
    named = table(spark, sf_dir, "customer").select("c_custkey", srs.alias("srs"))
    return named.select("c_custkey", *(c.alias(n) for n, c in files.crs_columns("srs").items()))


def geoid_names(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.get(F.array(*map(F.lit, ("egm96", "EGM2008", "Egm96", "egm84", "none"))), (k % 5).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.geoid_model(name).alias("model"))


def center_override(spark, sf_dir):
    """Centre of a job: only with a configuration; the command line wins where it is not 0."""
    k = F.col("c_custkey")
    has, cli, own = k % 3 != 0, (k % 4).cast("double"), (k % 7).cast("double")
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(has, F.coalesce(F.nullif(cli, F.lit(0.0)), own)).alias("lon"))


_SRS = "select c_custkey k, case when c_custkey % 2 = 0 then 'EPSG:' || c_custkey else 'A & ' || c_custkey end srs from customer"
_NAME = "case when o_orderkey % 3 = 0 then '_L' || (o_orderkey % 30) || '_0' when o_orderkey % 3 = 1 then 'x' || (o_orderkey % 100) else 'y' end"
_URL = "case when page_id % 3 = 0 then replace(url, '/', '\\') else url end"

QUERIES = {f.__name__: f for f in (xml_tag, xml_attr, xml_decode, metadata_srs, config_json, output_name, lod_level, path_parts, split_text, replace_first, uri_prefix, uri_rewrite, crs_dispatch, geoid_names, center_override)}

ORACLE_SQL = {
    "xml_tag": "select page_id, regexp_extract(html, '<title>((?s:.)*?)</title>', 1) title from pages",
    "xml_attr": "select page_id, regexp_extract(html, '<html[^>]*?\\slang=\"([^\"]*)\"', 1) lang from pages",
    "xml_decode": "select page_id, replace(replace(regexp_replace(replace(regexp_extract(html, '<title>((?s:.)*?)</title>', 1), '&quot;', '\"'), '&(amp;)+', '&', 'g'), '&lt;', '<'), '&gt;', '>') title from pages",
    "metadata_srs": f"select case when k % 2 = 0 then '1.0' else '1.1' end \"version\", srs, case when k % 2 = 0 then '1,2,' || k else '0,0,0' end srs_origin from ({_SRS})",
    "config_json": "select event_id, null::double x, case when event_id % 5 = 0 then null else json_extract(props, '$.k')::int end max_lvl from events",
    "output_name": "select o_orderkey, 'Tile_' || o_orderkey || case when o_orderkey % 3 = 2 then 'o.glb' else '.glb' end \"name\" from orders",
    "lod_level": f"select o_orderkey, case when o_orderkey % 3 = 0 then o_orderkey % 30 when o_orderkey % 3 = 1 then o_orderkey % 100 else -1 end::int \"level\" from orders",
    "path_parts": f"select page_id, regexp_extract(u, '([^/\\\\]*)$', 1) base, regexp_extract(u, '^(.*)[/\\\\][^/\\\\]*$', 1) parent from (select page_id, {_URL} u from pages)",
    "split_text": "select page_id, array_to_string(p, '|') parts, len(p)::int n from (select page_id, case when url like '%/' then list_slice(string_split(url, '/'), 1, -2) else string_split(url, '/') end p from pages)",
    "replace_first": "select page_id, regexp_replace(url, 'e', '<E>') url from pages",
    "uri_prefix": "select o_orderkey, './Data/T' || o_custkey || '/' || o_orderkey || '.glb' uri from orders",
    "uri_rewrite": "select o_orderkey, case when o_orderkey % 2 = 0 then '../Data/' else 'Data/' end || o_orderkey || '.glb' uri from orders",
    "crs_dispatch": "select c_custkey, case c_custkey % 4 when 0 then 'ENU' when 1 then 'EPSG' when 2 then 'WKT' else 'UNSUPPORTED' end crs_kind, case when c_custkey % 4 = 1 then c_custkey + 32600 end::int crs_code, case when c_custkey % 4 = 0 then c_custkey % 90 end::double crs_lat, case when c_custkey % 4 = 0 then c_custkey % 180 end::double crs_lon from customer",
    "geoid_names": "select c_custkey, case c_custkey % 5 when 0 then 'EGM96' when 1 then 'EGM2008' when 3 then 'EGM84' else 'NONE' end model from customer",
    "center_override": "select c_custkey, case when c_custkey % 3 <> 0 then case when c_custkey % 4 <> 0 then c_custkey % 4 else c_custkey % 7 end end::double lon from customer",
}
