"""Scans, load steps, sinks and checks over the benchmark tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import operators as ops
from leadloom import sources as src
from leadloom.bindings import derive
from leadloom.bindings.catalog import Catalog, flat
from leadloom.bindings.model_sql import with_models
from leadloom.build import land_raw, raw_violations
from leadloom.functions.jsonv import json_pack, json_text
from leadloom.schemas import KEEP_EMPTY, RAW, UNIQUE_KEYS, length_limits
from leadloom.session import shared_path

CATALOG = Catalog()
BATCH = derive.BATCH_TS


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


# --- table scans --------------------------------------------------------------


@CATALOG.query(
    "scan_query",
    "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 1000",
)
def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_source(
        spark,
        _path(sf_dir, "orders"),
        query="select o_orderkey, o_custkey, o_totalprice from src "
        "where o_orderstatus = 'F' and o_totalprice > 1000",
    )


@CATALOG.query("scan_table", "select c_custkey, c_mktsegment from customer")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_source(spark, _path(sf_dir, "customer"), columns=["c_custkey", "c_mktsegment"])


@CATALOG.query(
    "scan_tables_union",
    """
    select n_nationkey, n_name, n_regionkey, cast(null as integer) as r_regionkey,
           cast(null as varchar) as r_name, cast(null as bigint) as s_suppkey,
           cast(null as varchar) as s_name, cast(null as integer) as s_nationkey,
           cast(null as double) as s_acctbal, 'nation' as table_name from nation
    union all
    select null, null, null, r_regionkey, r_name, null, null, null, null, 'region' from region
    union all
    select null, null, null, null, null, s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' from supplier
    """,
)
def scan_tables_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["nation", "region", "supplier"]
    return src.read_tables(spark, {n: _path(sf_dir, n) for n in names})


# --- API pages ----------------------------------------------------------------

PAGE_SIZE = 25
ITEM = "id bigint, name string, segment string, balance double"


def _customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 25 consecutive customers, so a page is bounded by its number."""
    customer = derive.table(spark, sf_dir, "customer")
    item = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    page = F.floor(F.col("c_custkey") / PAGE_SIZE).alias("page")
    return customer.groupBy(page).agg(F.collect_list(item).alias("items"))


@CATALOG.query(
    "scan_api_pages",
    "select c_custkey as id, c_name as name, c_mktsegment as segment, c_acctbal as balance from customer",
)
def scan_api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = shared_path(spark, "pages")
    pages = _customer_pages(spark, sf_dir)
    envelope = F.struct(F.size("items").cast("long").alias("count"), "items")
    pages.select(F.to_json(envelope).alias("value")).write.text(landed)
    return src.read_api_pages(spark, landed, ITEM, one_per_line=True).drop("page_file")


@CATALOG.query(
    "scan_api_pages_meta",
    """
    select cast(floor(c_custkey / 25) as bigint) as page, c_custkey as id, c_name as name,
           c_mktsegment as segment, c_acctbal as balance from customer
    """,
)
def scan_api_pages_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _customer_pages(spark, sf_dir)
    meta = F.struct(
        F.lit(9).cast("long").alias("total_pages"),
        F.col("page").alias("page"),
        F.lit(PAGE_SIZE).cast("long").alias("limit"),
    )
    envelope = F.struct(F.lit(200).alias("code"), F.lit("Success").alias("message"), F.col("items").alias("data"), meta.alias("meta"))
    text = pages.select(F.to_json(envelope).alias("body"))
    parsed = src.parse_pages(text, "body", ITEM, items_field="data")
    return src.explode_pages(parsed.withColumn("page", F.col("meta.page")), "data", keep=("page",))


@CATALOG.query(
    "page_completeness",
    """
    with pages as (
        select c_mktsegment as endpoint, cast(floor(c_custkey / 100) as bigint) as page,
               count(*) as item_count
        from customer group by 1, 2
    ), ids as (
        select c_mktsegment as endpoint, count(distinct c_custkey) as distinct_ids,
               case c_mktsegment when 'AUTOMOBILE' then null when 'BUILDING' then count(*) + 1 else count(*) end as reported
        from customer group by c_mktsegment
    ), ends as (
        select endpoint, count(*) as pages, cast(sum(item_count) as bigint) as fetched,
               arg_max(item_count, page) as last_page_items,
               case endpoint when 'MACHINERY' then count(*) when 'FURNITURE' then count(*) + 1 end as total_pages
        from pages group by endpoint
    )
    select p.endpoint, i.reported, p.fetched, p.pages, p.total_pages, p.last_page_items, i.distinct_ids,
           (case when p.total_pages is null then p.last_page_items < 100 else p.pages >= p.total_pages end)
           and i.distinct_ids >= i.reported as complete
    from ends p join ids i on p.endpoint = i.endpoint
    """,
)
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints that report too many items, no count, all their pages, and one page more."""
    customer = derive.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("endpoint"), F.col("c_custkey").alias("id")
    )
    page = F.floor(F.col("id") / 100).alias("page")
    n, endpoint = F.count("*"), F.col("endpoint")
    claimed = customer.groupBy("endpoint").agg(
        F.when(endpoint == "BUILDING", n + 1).when(endpoint != "AUTOMOBILE", n).alias("count"),
        F.when(endpoint == "MACHINERY", F.count_distinct(page))
        .when(endpoint == "FURNITURE", F.count_distinct(page) + 1)
        .alias("announced"),
    )
    bodies = customer.groupBy("endpoint", page).agg(F.collect_list(F.struct("id")).alias("items"))
    meta = F.struct(F.col("announced").alias("total_pages"), F.lit(None).cast("long").alias("total_count"))
    pages = bodies.join(claimed, on="endpoint").withColumn("meta", meta)
    stats = src.page_stats(pages, "endpoint", page=F.col("page"))
    items = src.explode_pages(pages, "items", keep=("endpoint",))
    return ops.page_completeness(stats, items, "id", limit=100)


@CATALOG.query(
    "extract_faults",
    """
    with items as (
        select c_mktsegment as endpoint, c_custkey as id, cast(floor(c_custkey / 10) as bigint) + 1 as page from customer
        union all
        select c_mktsegment, c_custkey, cast(floor(c_custkey / 10) as bigint) + 2 from customer where c_custkey % 100 = 9
    ), landed as (
        select distinct endpoint, page, 1 as copy from items where page % 7 <> 3 and page not in (1, 2)
        union all
        select distinct endpoint, page, 2 from items where page % 21 = 5
    ), ends as (
        select endpoint, min(page) as low, max(page) as high, max(page) + 2 as total from landed group by endpoint
    ), missing as (
        select endpoint, page, lead(page) over (partition by endpoint order by page) as following
        from (select distinct endpoint, page from landed)
    ), kept as (
        select distinct i.* from items i join landed l on l.endpoint = i.endpoint and l.page = i.page
    )
    select endpoint, 'missing' as kind, page + 1 as first, following - 1 as last, following - page - 1 as n
    from missing where following > page + 1
    union all select endpoint, 'missing', 1, low - 1, low - 1 from ends where low > 1
    union all select endpoint, 'missing', high + 1, total, total - high from ends
    union all select endpoint, 'repeated', page, page, count(*) - 1 from landed group by endpoint, page having count(*) > 1
    union all
    select endpoint, 'overlap', page, page, count(*) from (
        select endpoint, page, page > min(page) over (partition by endpoint, id) as again from kept
    ) where again group by endpoint, page
    """,
)
def extract_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages, of which some never came, some came twice, and some repeat items."""
    customer = derive.table(spark, sf_dir, "customer")
    page = F.floor(F.col("c_custkey") / 10) + 1
    item = customer.select(F.col("c_mktsegment").alias("endpoint"), F.col("c_custkey").alias("id"), page.alias("page"))
    items = item.union(item.where("id % 100 = 9").withColumn("page", F.col("page") + 1))
    once = items.select("endpoint", "page").distinct()
    landed = once.where("page % 7 <> 3 and page not in (1, 2)")
    landed = landed.union(once.where("page % 21 = 5"))
    total = landed.groupBy("endpoint").agg((F.max("page") + 2).alias("total_pages"))
    kept = items.join(landed.distinct(), ["endpoint", "page"])
    return ops.extract_faults(landed.join(total, "endpoint"), kept, bucket=50)


@CATALOG.query(
    "attach_messages",
    """
    select d.doc_id, d.lang, c.turn + 1 as message_order, c.role, length(c."text") as n_chars
    from documents d left join conversations c on d.doc_id = c.conv_id
    union all
    select -1, null, row_number() over (order by event_id), event_type, length(props) from events where event_id % 3 = 0
    """,
)
def attach_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their turns, and one parent with a third of all events, a row per child."""
    parents = derive.table(spark, sf_dir, "documents").select("doc_id", "lang")
    children = derive.table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "doc_id")
    talks = ops.attach_rows(parents, children, "doc_id", "turn", ["role", "text"], "message_order")
    hot = (F.col("event_id") % 3 - 1).alias("doc_id")  # -1 for these
    said = derive.table(spark, sf_dir, "events").where("event_id % 3 = 0").select(
        hot, F.floor(F.col("event_id") / 3).alias("place"), F.col("event_type").alias("role"), F.col("props").alias("text")
    )
    chats = ops.attach_rows(said.select("doc_id").distinct(), said, "doc_id", "place", ["role", "text"], "message_order")
    both = talks.unionByName(chats, allowMissingColumns=True)
    return both.select("doc_id", "lang", "message_order", "role", F.char_length("text").cast("long").alias("n_chars"))


# --- surveys found in enrollments ------------------------------------------------

_SURVEY_MEMBERS = (
    with_models("raw_eduqat_enrollments")
    + """, worklist as (
        select r.id as enrollment_id, e.key as material_id,
               json_extract_string(e.value, '$.survey_id') as survey_id,
               json_extract_string(e.value, '$.completed_at') as completed_at, r.course_id, r.user_id
        from raw_eduqat_enrollments r, json_each(r.completions, '$.materials') e
        where json_type(r.completions, '$.materials') = 'OBJECT'
          and json_extract_string(e.value, '$.type') = 'survey'
          and json_extract_string(e.value, '$.survey_type') = 'survey'
          and json_extract_string(e.value, '$.completed_at') is not null
    )"""
)


@CATALOG.query("survey_worklist", _SURVEY_MEMBERS + " select * from worklist")
def survey_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.survey_worklist(derive.raw(spark, sf_dir, "eduqat_enrollments"))


@CATALOG.query(
    "survey_load",
    _SURVEY_MEMBERS
    + """
    select w.enrollment_id, w.material_id,
           coalesce(nullif(w.survey_id, ''), 'r' || o.o_orderkey) as survey_id, w.course_id, w.user_id,
           'survey' as survey_type, 'Title ' || (o.o_custkey % 9) as survey_title,
           case when o.o_custkey % 4 <> 0 then '[{"question":"q","responses":[' || (o.o_orderkey % 5) || ']}]' end as elements,
           cast(w.completed_at as timestamp) as completed_at, 'eduqat_survey_results' as data_source,
           timestamp '2024-06-10 00:00:00' as extracted_at
    from worklist w join orders o on w.enrollment_id = cast(o.o_orderkey as varchar)
     and w.material_id = cast(200 + o.o_orderkey % 50 as varchar) and o.o_orderkey % 5 <> 3
    """,
)
def survey_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    # some fetches failed, so their result carries no material
    material = F.when(key % 5 != 3, (key % 50 + 200).cast("string"))
    elements = F.when(
        F.col("o_custkey") % 4 == 0, F.lit("[]")
    ).otherwise(F.concat(F.lit('[{"question":"q","responses":['), (key % 5).cast("string"), F.lit("]}]")))
    doc = F.concat(
        F.lit('{"id":"r'), key.cast("string"),
        F.lit('","type":"survey","title":"Title '), (F.col("o_custkey") % 9).cast("string"),
        F.lit('","elements":'), elements, F.lit("}"),
    )
    results = orders.select(
        key.cast("string").alias("enrollment_id"),
        material.alias("material_id"),
        F.parse_json(doc).alias("survey_data"),
    )
    return flat(
        src.survey_load(survey_worklist(spark, sf_dir), results, "eduqat_survey_results", BATCH)
    )


# --- sheets -----------------------------------------------------------------------

_SHEET = {
    " Email ": "email",
    "No. HP/Telp": "phone_number",
    "Full Name": "nama_pemilik_usaha",
    "Nama Bisnis / Usaha yang Dimiliki": "nama_usaha",
    "Apakah kamu sudah memiliki NIB?": "memiliki_nib",
    "Created Time": "timestamp",
    "Provinsi": "provinsi_usaha",
}
_SHEET_SQL = {
    "email": "coalesce(email, '')",
    "no_hp_telp": "coalesce(phone_number, '')",
    "full_name": "coalesce(nama_pemilik_usaha, '')",
    "nama_bisnis_usaha_yang_dimiliki": "coalesce(nama_usaha, '')",
    "apakah_kamu_sudah_memiliki_nib": "coalesce(memiliki_nib, '')",
    "created_time": 'coalesce("timestamp", \'\')',
    "provinsi": "coalesce(provinsi_usaha, '')",
}
_SHEET_COLUMNS = ", ".join(f"{e} as {c}" for c, e in _SHEET_SQL.items())


def _landed_sheet(spark: SparkSession, leads: DataFrame, headers: list[str]) -> str:
    """A sheet export with the headers that people type."""
    path = shared_path(spark, "sheet")
    src.write_sheet(leads.select(*[F.col(_SHEET[h]).alias(h) for h in headers]), path)
    return path


@CATALOG.query("scan_sheet", with_models("raw_leads") + f" select {_SHEET_COLUMNS} from raw_leads")
def scan_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads")
    return src.read_sheet(spark, _landed_sheet(spark, leads, list(_SHEET)))


@CATALOG.query(
    "normalize_headers",
    'select s_suppkey as no_id, s_name as nama_pemasok_a_b, s_nationkey as kota, s_acctbal as saldo from supplier',
)
def normalize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = derive.table(spark, sf_dir, "supplier")
    typed = ["No. ID", " Nama Pemasok (a/b) ", "__Kota__", "SALDO"]
    return supplier.toDF(*src.normalize_headers(typed))


@CATALOG.query(
    "scan_sheet_header_row",
    """
    select cast(o_orderkey as varchar) as nomor, coalesce(o_orderpriority, '') as prioritas from orders
    """,
)
def scan_sheet_header_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that all start with a title row above the header, its cells full of line breaks."""
    orders = derive.table(spark, sf_dir, "orders")
    note = "\n" * 70
    path = shared_path(spark, "titled")
    titled = orders.select(F.col("o_orderkey").cast("string").alias("Nomor"), F.col("o_orderpriority").alias("Prioritas"))
    src.write_sheet(titled.toDF(f"Laporan{note}pesanan", "dibuat"), f"{path}/all")
    # the header as the first row below the title, in every file; a file per task of the scan
    rows = spark.read.option("multiLine", "true").options(quote='"', escape='"').csv(f"{path}/all", header=True)
    n = max(1, rows.rdd.getNumPartitions())
    head = spark.range(n).select(F.col("id").cast("int").alias("part"), F.lit("Nomor").alias("a"), F.lit("Prioritas").alias("b"))
    for k in range(2):
        body = rows.toDF("a", "b").where(F.pmod(F.crc32(F.col("a").cast("binary")), F.lit(2)) == k)
        body = body.select(F.pmod(F.xxhash64("a"), F.lit(n)).cast("int").alias("part"), "a", "b", F.lit(1).alias("below"))
        sheet = head.withColumn("below", F.lit(0)).unionByName(body).repartitionById(n, "part").sortWithinPartitions("below")
        sheet = sheet.select("a", "b").toDF(f"Laporan{note}pesanan", "dibuat")
        sheet.write.options(quote='"', escape='"').csv(f"{path}/parts/{k}", header=True)
    sheets = [src.read_sheet(spark, f"{path}/parts/{k}", header_row=1) for k in range(2)]
    return sheets[0].unionByName(sheets[1])


@CATALOG.query(
    "scan_sheet_multiline_header",
    """
    select coalesce(c_name, '') as nama_pelanggan, coalesce(c_mktsegment, '') as segmen,
           'Provinsi ' || c_nationkey as provinsi from customer
    """,
)
def scan_sheet_multiline_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header cell that holds more line breaks than most sheets have rows."""
    customer = derive.table(spark, sf_dir, "customer")
    path = shared_path(spark, "tall")
    province = F.concat(F.lit("Provinsi "), F.col("c_nationkey").cast("string"))
    typed = customer.select("c_name", "c_mktsegment", province).toDF("Nama" + "\n" * 200 + "Pelanggan", "Segmen", "Provinsi")
    src.write_sheet(typed, path)
    return src.read_sheet(spark, path)


@CATALOG.query(
    "scan_sheet_line_breaks",
    "select cast(doc_id as varchar) as nomor, coalesce(text, '') as isi, coalesce(source, '') as sumber from documents",
)
def scan_sheet_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, one per task that reads the table, whose cells are whole texts with line breaks and
    quotes, each cut into records by many tasks: most cells lie over a border between chunks."""
    documents = derive.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = shared_path(spark, "texts")
    src.write_sheet(documents.toDF("Nomor", "Isi", "Sumber"), path)
    return src.read_sheet(spark, path, chunk_chars=2_000)


_SHEET_OF = {
    "leads_ads_community": list(_SHEET),
    "website_form_responses": [" Email ", "No. HP/Telp", "Created Time"],
    "leads_course_strategi_ads": [" Email ", "Full Name", "Provinsi"],
    "branding_level_up": ["No. HP/Telp", "Created Time", " Email "],
    "Template": [" Email "],
}
_SHEET_NAMES = dict(zip(_SHEET, _SHEET_SQL, strict=True))


def _all_sheets_sql() -> str:
    parts = []
    for name, headers in _SHEET_OF.items():
        if name != "Template":
            has = {_SHEET_NAMES[h] for h in headers}
            columns = ", ".join(f"{e if c in has else 'cast(null as varchar)'} as {c}" for c, e in _SHEET_SQL.items())
            parts.append(f"select {columns}, data_source as sheet_name from raw_leads where data_source = '{name}'")
    return with_models("raw_leads") + " " + " union all ".join(parts)


@CATALOG.query("scan_all_sheets", _all_sheets_sql())
def scan_all_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {}
    for name, headers in _SHEET_OF.items():
        source = "branding_level_up" if name == "Template" else name
        paths[name] = _landed_sheet(spark, derive.raw_leads(spark, sf_dir, source), headers)
    return src.read_all_sheets(spark, paths, exclude=["Template"])


@CATALOG.query(
    "rename_synonyms",
    with_models("raw_leads")
    + """
    select email, phone_number, nama_pemilik_usaha, nama_usaha, memiliki_nib, "timestamp",
           provinsi_usaha as dimana_anda_menjalankan_usaha_provinsi_domisili,
           sheet_name as provinsi_usaha from raw_leads
    """,
)
def rename_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second province column keeps its own name: the target is taken."""
    leads = derive.raw_text(spark, sf_dir, "leads")
    typed = leads.select(
        "email",
        F.col("phone_number").alias("no_hp_telp"),
        F.col("nama_pemilik_usaha").alias("full_name"),
        F.col("nama_usaha").alias("nama_bisnis_usaha_yang_dimiliki"),
        F.col("memiliki_nib").alias("apakah_kamu_sudah_memiliki_nib"),
        F.col("timestamp").alias("created_time"),
        F.col("sheet_name").alias("di_provinsi_mana_usaha_kamu_beroperasi"),
        F.col("provinsi_usaha").alias("dimana_anda_menjalankan_usaha_provinsi_domisili"),
    )
    return src.rename_synonyms(typed)


@CATALOG.query(
    "rename_synonyms_coalesce",
    with_models("raw_leads")
    + """
    select id, coalesce(nullif(phone_number, ''), nullif(nama_akun_ecommerce, ''), phone_number) as phone_number
    from raw_leads
    """,
)
def rename_synonyms_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads").select(
        "id", "phone_number", F.col("nama_akun_ecommerce").alias("no_telp")
    )
    return src.rename_synonyms(leads, mode="coalesce_all")


@CATALOG.query(
    "write_sheet",
    """
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_orderdate as varchar) as o_orderdate,
           case when o_orderstatus = 'P' then '' else o_orderpriority end as note from orders
    """,
)
def write_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    note = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("note")
    path = shared_path(spark, "out")
    src.write_sheet(orders.select("o_orderkey", "o_orderdate", note), path)
    schema = "o_orderkey string, o_orderdate string, note string"
    return spark.read.schema(schema).csv(path, header=True).na.fill("")


# --- load steps -----------------------------------------------------------------


@CATALOG.query(
    "surrogate_key",
    """
    select row_number() over (order by o_orderdate, o_orderkey) as id, o_orderkey as source_id,
           o_custkey, o_orderdate from orders
    """,
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderdate")
    return ops.add_surrogate_key(rows, order_by=[F.col("o_orderdate"), F.col("id")])


_PACKABLE = ["[]", "{}", "false", "0", '""', "null", '[1,"a"]', '{"k":0}', "true", '"x"', "7", None]


@CATALOG.query(
    "json_pack",
    f"""
    with t as (select o_orderkey, {derive._pick("o_orderkey", _PACKABLE)} as doc from orders)
    select o_orderkey, case when doc in ('[]', '{{}}', 'false', '0', '""', 'null') then null else doc end as packed,
           doc as kept from t
    """,
)
def json_pack_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    docs = orders.selectExpr("o_orderkey", f"parse_json({derive._pick('o_orderkey', _PACKABLE)}) as doc")
    doc = F.col("doc")
    kept = json_pack(doc, falsy_to_null=False)
    return docs.select(
        "o_orderkey", F.to_json(json_pack(doc)).alias("packed"), F.to_json(kept).alias("kept")
    )


@CATALOG.query(
    "stamp_provenance",
    """
    select event_id, event_type, 'events' as data_source, timestamp '2024-06-10 00:00:00' as extracted_at
    from events
    """,
)
def stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.stamp(derive.table(spark, sf_dir, "events").select("event_id", "event_type"), "events", BATCH)


@CATALOG.query(
    "typed_load",
    with_models("raw_purchase_form_data")
    + """
    select customer_name, email, phone_number, created_at, paid_at, product_type, course_id,
           cast(cast(amount as decimal(38, 6)) as double) as amount, payment_method,
           cast(null as varchar) as payment_channel, data_source, extracted_at
    from raw_purchase_form_data
    """,
)
def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of texts, with an offset in one timestamp and a column missing."""
    raw = derive.raw_text(spark, sf_dir, "purchase_form_data").drop("payment_channel")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    text = text.withColumn("created_at", F.concat(F.col("created_at"), F.lit("+07:00")))
    return flat(src.typed_load(text, RAW["purchase_form_data"]))


_NOTHING = "('[]', '{}', 'null', 'false', '0', '\"\"')"
_DECIMALS = {"purchase_form_data": ("amount",), "eduqat_courses": ("rating",)}


def _typed_sql(table: str) -> str:
    columns = []
    for c in derive.columns_of(table, "timestamp"):
        if c == "completions":
            # its members are compared by json_typeof and the staged materials; here, that it is there
            columns.append("completions is not null as completions")
        elif c in derive.JSON_COLUMNS.get(table, ()) and (table, c) != ("users", "interests"):
            columns.append(f'case when "{c}" in {_NOTHING} then null else "{c}" end as "{c}"')
        elif c == "birth_date":
            columns.append("cast(birth_date as varchar) as birth_date")
        elif c in _DECIMALS.get(table, ()):
            columns.append(f'cast(cast("{c}" as decimal(38, 6)) as double) as "{c}"')
        else:
            columns.append(f'"{c}"')
    return with_models(f"raw_{table}") + f" select {', '.join(columns)} from raw_{table}"


def _typed(table: str) -> None:
    @CATALOG.query(f"typed_load_{table}", _typed_sql(table))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """An extract of texts, its timestamps with an offset, its JSON not parsed."""
        raw = derive.raw_text(spark, sf_dir, table)
        stamps = [c for c, t in raw.dtypes if t == "timestamp_ntz" and c != "extracted_at"]
        text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
        text = text.withColumns({c: F.concat(F.col(c), F.lit("+07:00")) for c in stamps})
        loaded = src.typed_load(text, RAW[table], keep_empty=KEEP_EMPTY.get(table, ()))
        if "completions" in loaded.columns:
            loaded = loaded.withColumn("completions", F.col("completions").isNotNull())
        return flat(loaded)


for _table in derive.DERIVED:
    if _table != "leads":
        _typed(_table)


@CATALOG.query(
    "retype_column",
    "select o_orderkey, case when o_orderstatus = 'O' then null when o_orderkey % 2 = 0 then 'true' else 'false' end as order_data from orders",
)
def retype_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey") % 2 == 0).alias("order_data")
    return flat(src.retype(derive.table(spark, sf_dir, "orders").select("o_orderkey", flag), "order_data"))


@CATALOG.query(
    "stable_surrogate_key",
    """
    with first_extract as (
        select c_custkey, 0 as copy from customer where c_custkey % 3 <> 0
        union all select c_custkey, 1 from customer where c_custkey % 10 = 1
    ), later_extract as (
        select c_custkey, 0 as copy from customer where c_custkey % 5 <> 0
        union all select c_custkey, 1 from customer where c_custkey % 10 in (1, 2)
    ), numbered as (
        select c_custkey, copy, row_number() over (order by c_custkey, copy) as id
        from first_extract where c_custkey % 3 <> 0 or copy = 1
    ), added as (
        select c_custkey, copy, (select max(id) from numbered) + row_number() over (order by c_custkey, copy) as id
        from (select *, row_number() over (partition by c_custkey order by copy) as nth from later_extract) l
        where nth > (select count(*) from numbered n where n.c_custkey = l.c_custkey)
    ), dictionary as (
        select c_custkey, id, row_number() over (partition by c_custkey order by id) as nth
        from (select c_custkey, id from numbered union all select c_custkey, id from added)
    )
    select l.c_custkey, d.id
    from (select c_custkey, row_number() over (partition by c_custkey) as nth from later_extract) l
    join dictionary d using (c_custkey, nth)
    """,
)
def stable_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later extract, with rows gone, new ones, and some more often than before, keeps the
    numbers of the first."""
    customer = derive.table(spark, sf_dir, "customer").select("c_custkey")
    key = F.col("c_custkey")
    path = shared_path(spark, "keys")
    extracts = [
        customer.where(key % 3 != 0).union(customer.where(key % 10 == 1)),
        customer.where(key % 5 != 0).union(customer.where((key % 10).isin(1, 2))),
    ]
    for extract in extracts:
        keyed = ops.stable_surrogate_key(extract, ["c_custkey"], path)
    return keyed.select("c_custkey", "id")


@CATALOG.query("full_refresh", "select * from part")
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, empty extract leaves the first one in place."""
    part = derive.table(spark, sf_dir, "part")
    path = shared_path(spark, "part")
    src.full_refresh(derive.table(spark, sf_dir, "part").withColumn("old", F.lit(1)), path)
    src.full_refresh(part, path)
    src.full_refresh(part.where(F.col("p_partkey") < 0), path)
    return src.read_source(spark, path)


@CATALOG.query(
    "concurrent_refresh",
    "select o_orderkey, o_orderstatus, o_totalprice from orders",
)
def concurrent_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writers that race to refresh one table: every one becomes a version, and none is lost."""
    orders = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = shared_path(spark, "raced")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda s: src.full_refresh(orders.where(F.col("o_orderstatus") == s), path), "FOP"))
    kept = [src.read_source(spark, path, version=v.number) for v in src.versions(spark, path)]
    return ops.union_all(*kept)


@CATALOG.query(
    "materialize_view",
    "select s_nationkey, count(*) as suppliers, max(s_acctbal) as best from supplier where s_acctbal > 0 group by 1",
)
def materialize_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view is recomputed on read; filters and columns still reach the scan."""
    src.materialize(derive.table(spark, sf_dir, "supplier"), "all_suppliers")
    return spark.sql(
        "select s_nationkey, count(*) as suppliers, max(s_acctbal) as best "
        "from all_suppliers where s_acctbal > 0 group by s_nationkey"
    )


@CATALOG.query(
    "materialize_table",
    """
    select c_mktsegment, c_nationkey, count(*) as customers from customer
    group by c_mktsegment, c_nationkey
    """,
)
def materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = src.materialize(derive.table(spark, sf_dir, "customer"), "all_customers")
    counts = customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("customers"))
    return src.materialize(counts, "customer_counts", "table", shared_path(spark, "tables"))


# --- checks ---------------------------------------------------------------------


@CATALOG.query(
    "assert_unique",
    """
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1
    """,
)
def assert_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.violations_unique(derive.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@CATALOG.query(
    "assert_not_null",
    with_models("raw_leads")
    + """
    select id, concat_ws(',', case when email is null then 'email' end,
                         case when phone_number is null then 'phone_number' end) as violated
    from raw_leads where email is null or phone_number is null
    """,
)
def assert_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = derive.raw_text(spark, sf_dir, "leads").select("id", "email", "phone_number")
    bad = ops.violations_null(leads, ["email", "phone_number"])
    return bad.select("id", F.array_join("violated", ",").alias("violated"))


@CATALOG.query(
    "assert_length",
    """
    select doc_id, concat_ws(',', case when length("text") > 500 then 'text' end,
                             case when length(source) > 5 then 'source' end) as violated
    from documents where length("text") > 500 or length(source) > 5
    """,
)
def assert_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = derive.table(spark, sf_dir, "documents")
    bad = ops.violations_length(documents, {"text": 500, "source": 5})
    return bad.select("doc_id", F.array_join("violated", ",").alias("violated"))


_TALKS = ("eduqat_ai_conversations", "eduqat_ai_messages")
_CHECKED = (*[t for t in derive.DERIVED if t != "leads"], *_TALKS)


def _contract_sql() -> str:
    parts = []
    for table in _CHECKED:
        there = derive.DERIVED[table][1] if table in derive.DERIVED else RAW[table]
        too_long = " or ".join(f'length("{c}") > {n}' for c, n in length_limits(table).items() if c in there)
        head = f"select '{table}' as table_name, '{{}}' as rule, count(*) as violations from "
        parts.append(head.format("length") + f"raw_{table} where {too_long}")
        for key in UNIQUE_KEYS.get(table, []):
            cols = ", ".join(key)
            twice = f"(select {cols} from raw_{table} group by {cols} having count(*) > 1)"
            nulls = " or ".join(f"{c} is null" for c in key)
            parts.append(head.format(f"unique {cols}") + twice)
            parts.append(head.format(f"not null {cols}") + f"raw_{table} where {nulls}")
    return f"{with_models(*[f'raw_{t}' for t in _CHECKED])} {' union all '.join(parts)}"


@CATALOG.query("assert_raw_contract", _contract_sql())
def assert_raw_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadloom.bindings.models import Models

    m = Models(spark, sf_dir)
    raw = {t: derive.raw(spark, sf_dir, t) for t in _CHECKED if t not in _TALKS}
    return raw_violations(raw | dict(zip(_TALKS, (m.raw_conversations(), m.raw_messages()), strict=True)))


@CATALOG.query(
    "land_raw_contract",
    """
    with extract as (
        select o_orderkey as id, case when o_orderkey % 10 = 0 then null else o_custkey end as enrollment,
               repeat('x', cast(o_orderkey % 120 as integer)) as long_text from orders
    )
    select 'not null enrollment_id, material_id' as rule, count(*) filter (where enrollment is null) as violations from extract
    union all select 'unique enrollment_id, material_id', count(*) from
        (select enrollment from extract where enrollment is not null group by enrollment having count(*) > 1)
    union all select 'length', count(*) filter (where length(long_text) > 50) from extract
    union all select 'rows', count(*) from extract
    """,
)
def land_raw_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey results that break all rules of their table, counted while they are landed."""
    orders = derive.table(spark, sf_dir, "orders")
    extract = orders.select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).cast("string").alias("enrollment_id"),
        F.lit("m").alias("material_id"),
        F.repeat(F.lit("x"), (F.col("o_orderkey") % 120).cast("int")).alias("survey_type"),
    )
    path = shared_path(spark, "contract")
    raw = src.typed_load(extract, RAW["eduqat_survey_results"], strict=False)
    version, violations = land_raw(raw, "eduqat_survey_results", path)
    # driver values that are counts of the landed rows
    found = [*violations.items(), ("rows", version.rows)]
    return spark.createDataFrame(found, "rule string, violations long")


_BROKEN = """
    case o_orderkey % 5 when 0 then null when 1 then '{"k":' when 2 then '{"k":' || cast(o_orderkey as string) || '}'
    when 3 then '[1,2' else '{"k":null}' end
"""


@CATALOG.query(
    "tolerate_bad_items",
    f"""
    with t as (select o_orderkey, o_orderstatus, {_BROKEN} as body from orders)
    select o_orderstatus, count(*) filter (where json_valid(body)) as loaded,
           count(*) filter (where not coalesce(json_valid(body), false)) as rejected,
           cast(sum(cast(case when json_valid(body) then json_extract_string(body, '$.k') end as bigint)) as bigint) as k_sum
    from t group by o_orderstatus
    """,
)
def tolerate_bad_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = derive.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{_BROKEN} as body")
    good, rejects = src.parse_items(landed, "body")
    loaded = good.groupBy("o_orderstatus").agg(
        F.count("*").alias("loaded"),
        F.sum(json_text(F.col("item"), "$.k").cast("long")).alias("k_sum"),
    )
    rejected = rejects.groupBy("o_orderstatus").agg(F.count("*").alias("rejected"))
    joined = loaded.join(rejected, on="o_orderstatus", how="full")
    return joined.select(
        "o_orderstatus",
        F.coalesce("loaded", F.lit(0)).alias("loaded"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"),
        "k_sum",
    )


@CATALOG.query(
    "category_counts",
    """
    select coalesce(nullif(o_orderpriority, '1-URGENT'), 'UNKNOWN') as o_orderpriority,
           count(*) as row_count from orders group by 1
    """,
)
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derive.table(spark, sf_dir, "orders")
    known = F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    return ops.category_counts(orders.withColumn("o_orderpriority", known), "o_orderpriority")


@CATALOG.query(
    "row_audit",
    with_models("mart_enrollment")
    + """
    select count(*) as row_count, count(distinct enrollment_id) as key_count,
           count(*) = count(distinct enrollment_id) as grain_holds from mart_enrollment
    """,
)
def row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from leadloom.bindings.models import Models

    return ops.row_audit(Models(spark, sf_dir).enrollment(), ["enrollment_id"])
