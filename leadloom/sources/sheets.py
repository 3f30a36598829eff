"""Spreadsheet exports (CSV files or folders of CSV files) in and out."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.sources.records import CHUNK_CHARS, Records

# Normalised sheet header -> column name.
HEADER_SYNONYMS: dict[str, str] = {
    "phone_number": "phone_number",
    "no_hp_telp": "phone_number",
    "no_telp": "phone_number",
    "customer_phone": "phone_number",
    "email": "email",
    "customer_email": "email",
    "nama_bisnis_usaha_yang_dimiliki": "nama_usaha",
    "nama_usaha": "nama_usaha",
    "nama_pemilik_usaha": "nama_pemilik_usaha",
    "full_name": "nama_pemilik_usaha",
    "apa_nama_akun_media_sosial_jualan_usaha_kamu": "nama_akun_media_sosial",
    "nama_akun_media_sosial_atau_marketplace_jualan_anda_cth_instagram_tiktok_facebook_shopee_tokopedia_dll": "nama_akun_media_sosial",
    "apa_nama_akun_e_commerce_atau_marketplace_jualan_usaha_kamu": "nama_akun_ecommerce",
    "bidang_usaha_yang_sedang_dijalankan_saat_ini_cth_pakaian_makana": "bidang_usaha",
    "bidang_usaha": "bidang_usaha",
    "jenis_produk_atau_jasa_yang_dihasilkan": "bidang_usaha",
    "lama_usaha_bisnis_telah_berdiri": "lama_usaha",
    "berapa_lama_umkm_sudah_beroperasi": "lama_usaha",
    "di_provinsi_mana_usaha_kamu_beroperasi": "provinsi_usaha",
    "dimana_anda_menjalankan_usaha_provinsi_domisili": "provinsi_usaha",
    "pendapatan_bulanan_rata_rata": "pendapatan_bulanan",
    "apakah_anda_saat_ini_tergabung_ke_dalam_komunitas_umkm": "tergabung_komunitas_umkm",
    "apakah_kamu_sudah_memiliki_nib": "memiliki_nib",
    "apa_kamu_sudah_memiliki_sertifikasi_halal": "memiliki_sertifikasi_halal",
    "timestamp": "timestamp",
    "created_time": "timestamp",
    "customer_name": "customer_name",
    "paid_at": "paid_at",
}

# length at which the landing database cuts column names
MAX_NAME_BYTES = 63


def normalize_headers(names: Sequence[str], max_bytes: int | None = None) -> list[str]:
    """Lower case, anything but a-z, 0-9 and _ to _, runs of _ to one, none at
    the ends. ``max_bytes`` cuts the name, which belongs after the synonyms."""
    out = [re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", n.lower())).strip("_") for n in names]
    return [n[:max_bytes] for n in out] if max_bytes else out


def _all_text(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def _header(text: str, where: str) -> list[str]:
    """Normalised cells of a header's record."""
    names = normalize_headers(next(csv.reader(io.StringIO(text, newline=""))))
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated or "" in names:
        raise ValueError(f"{where}: empty or repeated headers after normalisation: {repeated or ['']}")
    return names


def _headers(records: Records, header_row: int) -> tuple[dict[str, list[str]], set[str]]:
    """Header of each sheet that has any record, and the sheets that have rows below it.

    The driver gets one row per sheet and distinct header, with the header's record; all other
    text stays in the tasks.
    """
    files = records.files().join(records.numbered(number=header_row), ["sheet", "file"], "left").where("n > 0 or unclosed")
    by_header = files.groupBy("sheet", "text", "unclosed").agg(F.min("file").alias("file"), F.max("n").alias("n"))
    found = by_header.collect()
    unclosed = sorted(r.file for r in found if r.unclosed)
    if unclosed:
        raise ValueError(f"no readable header or row: a quoted cell never closes in {', '.join(unclosed)}")
    headers: dict[str, list[str]] = {}
    filled = set()
    for r in sorted(found, key=lambda r: r.file):
        if r.text is None:
            raise ValueError(f"{r.file}: no readable header in row {header_row}")
        names = _header(r.text, r.file)
        if headers.setdefault(r.sheet, names) != names:
            raise ValueError(f"{r.file}: another header than in the files before it")
        if r.n > header_row + 1:
            filled.add(r.sheet)
    return headers, filled


# as the reader of whole files takes them
_CSV = {"quote": '"', "escape": '"', "multiLine": "true"}


def _cells(rows: DataFrame, width: int) -> DataFrame:
    """sheet and the cells c0, c1, ... of records; short rows are padded, cells beyond are cut."""
    parsed = rows.select("sheet", F.from_csv("text", _all_text(width).simpleString()[7:-1].replace(":", " "), _CSV).alias("c"))
    return parsed.select("sheet", *[F.coalesce(F.col(f"c.c{i}"), F.lit("")).alias(f"c{i}") for i in range(width)])


def read_sheet(
    spark: SparkSession,
    path: str,
    header_row: int = 0,
    multi_line: bool = True,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One sheet, all columns text, headers normalised.

    ``path`` is a CSV file, or a folder of CSV files that all repeat the header; another header
    in one of them raises. Short rows are padded and empty cells read as the empty string; cells
    beyond the header are cut; empty lines are no rows. With ``header_row`` > 0 the rows above the
    header are ignored. Cells may contain line breaks, and a file of any size is read by many
    tasks all the same (``leadloom.sources.records``); a cell that never closes raises. With
    ``multi_line=False`` every line is a row. The text is written once, in chunks, below the
    shared folder.
    """
    records = Records(spark, {"": path}, multi_line, chunk_chars)
    headers, _ = _headers(records, header_row)
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    return _cells(records.numbered(after=header_row), len(headers[""])).drop("sheet").toDF(*headers[""])


def sheet_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Sheet name -> path of the exports in a workbook's folder, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    paths = sorted(e.getPath().toString() for e in entries)
    named = {p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv"): p for p in paths}
    return {name: p for name, p in named.items() if not name.startswith(("_", "."))}


def read_all_sheets(
    spark: SparkSession,
    paths: Mapping[str, str],
    header_row: int = 0,
    exclude: Collection[str] = (),
    multi_line: bool = True,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """All sheets of a workbook, stacked by column name and tagged sheet_name.

    A column that a sheet lacks reads NULL there; a sheet without rows adds no columns. All sheets
    are read by the same few jobs, however many there are.
    """
    kept = {name: path for name, path in paths.items() if name not in exclude}
    if not kept:
        return spark.createDataFrame([], T.StructType([]))
    records = Records(spark, kept, multi_line, chunk_chars)
    headers, filled = _headers(records, header_row)
    headers = {name: headers[name] for name in kept if name in filled}
    if not headers:
        return spark.createDataFrame([], T.StructType([]))
    width = max(map(len, headers.values()))
    cells = _cells(records.numbered(after=header_row), width)
    # name -> position -> sheets that have it there; the tag follows the first sheet's columns
    place: dict[str, dict[int, list[str]]] = {}
    for sheet, names in headers.items():
        for i, name in enumerate([*names, "sheet_name"]):
            place.setdefault(name, {}).setdefault(i, []).append(sheet)
    sheet = F.col("sheet")
    columns = {
        name: F.coalesce(*[F.when(sheet.isin(sheets), F.col(f"c{i}")) for i, sheets in at.items() if i < width])
        for name, at in place.items()
        if name != "sheet_name"
    }
    return cells.select(*[sheet.alias(n) if n == "sheet_name" else columns[n].alias(n) for n in place])


def rename_synonyms(
    df: DataFrame, mapping: Mapping[str, str] | None = None, mode: str = "first_wins"
) -> DataFrame:
    """Give synonym columns their common name.

    ``first_wins``: a column is renamed if no column has the common name yet and
    no earlier synonym took it; further synonyms keep their own name.
    ``coalesce_all``: all synonyms are merged, the first non-empty value in
    mapping order wins.
    """
    synonyms = HEADER_SYNONYMS if mapping is None else mapping
    present = [s for s in synonyms if s in df.columns]
    if mode == "first_wins":
        renames: dict[str, str] = {}
        for s in present:
            target = synonyms[s]
            if target not in df.columns and target not in renames.values():
                renames[s] = target
        return df.withColumnsRenamed(renames)
    if mode != "coalesce_all":
        raise ValueError(f"mode must be 'first_wins' or 'coalesce_all', not {mode!r}")
    merged: dict[str, list[str]] = {}
    for s in sorted(present, key=lambda s: s != synonyms[s]):
        merged.setdefault(synonyms[s], []).append(s)
    used = {s for group in merged.values() for s in group}
    keep = [F.col(c) for c in df.columns if c not in used]
    pick = [
        F.coalesce(*[F.nullif(F.col(s), F.lit("")) for s in group], F.col(group[0])).alias(target)
        for target, group in merged.items()
    ]
    return df.select(*keep, *pick)


def write_sheet(df: DataFrame, path: str, include_index: bool = False) -> None:
    """Replace a sheet: header plus rows, timestamps as text, NULL as ''.

    The folder holds one CSV file per task, each with the header, so that no task
    sees all rows; read_sheet takes the folder as one sheet.
    """
    if include_index:
        from leadloom.operators.keys import add_surrogate_key

        order = [F.col(c).asc_nulls_first() for c in df.columns]
        df = add_surrogate_key(df, order_by=order, name="index", start=0)
    # typed headers may contain dots
    cells = {c: F.col("`" + c.replace("`", "``") + "`").cast("string") for c in df.columns}
    text = df.select(*[F.coalesce(cell, F.lit("")).alias(c) for c, cell in cells.items()])
    # the writer would trim cells by default
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    text.write.mode("overwrite").options(quote='"', escape='"', **keep).csv(path, header=True)
