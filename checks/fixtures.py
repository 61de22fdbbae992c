"""Messy tables derived from the driver tables.

The derivations are SQL texts that mean the same in Spark and DuckDB, so that a
query and its oracle start from the same rows.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.workspace import scratch_path


def padded(key: str, digits: int) -> str:
    text = f"cast({key} as string)"
    return f"lpad({text}, cast(greatest({digits}, length({text})) as int), '0')"


PARTS = f"""
select p_partkey,
  case p_partkey % 20
    when 0 then 'P' || cast(p_partkey as string)
    when 1 then '2019-PN-' || cast(p_partkey as string)
    when 2 then 'BOGUS-' || cast(p_partkey as string)
    when 3 then ' PN-' || {padded("p_partkey", 4)} || ' '
    when 4 then cast(null as string)
    else 'PN-' || {padded("p_partkey", 4)} end as part_number,
  p_name as name, p_type as category, 'EA' as uom, 'active' as status
from part"""

SUPPLIERS = f"""
select s.s_suppkey, 'SUP-' || {padded("s.s_suppkey", 4)} as supplier_code,
  case s.s_suppkey % 4
    when 0 then p.p_name || ' ' || lower(p.p_type)
    when 1 then upper(p.p_name || ' ' || p.p_type)
    when 2 then p.p_name || ' ' || lower(p.p_type) || ' Inc.'
    else lower(p.p_type) || ' ' || p.p_name end as name,
  case s.s_suppkey % 10
    when 0 then 'procurement.example.com'
    when 1 then 'sales desk@example.com'
    when 2 then 'buyer@example.com.invalid'
    when 3 then cast(null as string)
    when 4 then ' ok@example.com '
    else 'ok@example.com' end as contact_email
from supplier s join part p on p.p_partkey = s.s_suppkey - s.s_suppkey % 4"""

CHANGE_ORDERS = f"""
select o.o_orderkey, 'CO-' || {padded("o.o_orderkey", 6)} as co_number,
  case o.o_orderkey % 16
    when 0 then 'OPEN' when 1 then 'In-Work' when 2 then 'in_review' when 3 then 'Approved'
    when 4 then 'APPROVED' when 5 then 'CLOSED' when 6 then 'REJECTED' when 7 then 'Open'
    when 8 then cast(null as string) when 9 then 'in-review' when 10 then 'approved'
    when 11 then 'closed' when 12 then 'rejected' else 'open' end as state,
  o.o_orderdate as opened_at, l.closed_at
from orders o left join
  (select l_orderkey, min(l_shipdate) as closed_at from lineitem group by l_orderkey) l
  on l.l_orderkey = o.o_orderkey"""

# Injected keys, with deliberate disagreement: the state spelled 'Open' cannot be
# detected, and every 50th impossible date is left out of the truth.
TRUTH = f"""
select '{fixed.PART_NUMBERS}' as category, part_number as record_key
  from parts_messy where p_partkey % 20 in (0, 1, 2)
union all select '{fixed.INVALID_EMAILS}', supplier_code
  from suppliers_messy where s_suppkey % 10 in (0, 1, 2)
union all select '{fixed.STATE_VARIANTS}', co_number
  from change_orders_messy where o_orderkey % 16 in (0, 1, 2, 3, 4, 5, 6, 7)
union all select '{fixed.IMPOSSIBLE_DATES}', co_number
  from change_orders_messy where closed_at < opened_at and o_orderkey % 50 <> 0
union all select '{fixed.NEAR_DUPLICATES}', x.supplier_code || '->' || y.supplier_code
  from suppliers_messy x join suppliers_messy y
    on x.s_suppkey - x.s_suppkey % 4 = y.s_suppkey - y.s_suppkey % 4
   and y.s_suppkey < x.s_suppkey"""

# The same names under codes that repeat, and under codes with an arrow in them.
REPEATED = f"""
select s_suppkey, 'SUP-' || {padded("s_suppkey % 30", 4)} as supplier_code, name, contact_email
from suppliers_messy"""
ARROWS = """
select s_suppkey, case s_suppkey % 5 when 0 then 'A->B' when 1 then 'A' when 2 then 'B->C'
  else 'C' end || case when s_suppkey % 2 = 0 then '' else '->' || cast(s_suppkey % 7 as string) end
  as supplier_code, name, contact_email
from suppliers_messy"""
# Every code also with a name that all share, and few codes with many names each.
SHARED = """
select s_suppkey, supplier_code, name from suppliers_messy
union all select 1000000 + s_suppkey, supplier_code,
  case when s_suppkey % 2 = 0 then 'Unknown Vendor' else 'VENDOR unknown' end from suppliers_messy"""
MANY_NAMES = f"""
select s_suppkey, 'SUP-' || {padded("s_suppkey % 3", 4)} as supplier_code, name from suppliers_messy
union all select 1000000 + s_suppkey, 'ONE-' || {padded("s_suppkey", 4)}, name from suppliers_messy"""
# Plain numbered names, nearly all of them alike.
NUMBERED = f"""
select s_suppkey, 'SUP-' || {padded("s_suppkey", 4)} as supplier_code, s_name as name from supplier"""


def pair_truth(table: str) -> str:
    return f"""
select distinct '{fixed.NEAR_DUPLICATES}' as category,
  greatest(x.supplier_code, y.supplier_code) || '->' || least(x.supplier_code, y.supplier_code) as record_key
from {table} x join {table} y on x.s_suppkey - x.s_suppkey % 4 = y.s_suppkey - y.s_suppkey % 4
 and y.s_suppkey < x.s_suppkey"""


MESSY = {
    "parts_messy": PARTS,
    "suppliers_messy": SUPPLIERS,
    "change_orders_messy": CHANGE_ORDERS,
    "truth": TRUTH,
    "suppliers_repeated": REPEATED,
    "truth_repeated": pair_truth("suppliers_repeated"),
    "suppliers_arrows": ARROWS,
    "truth_arrows": pair_truth("suppliers_arrows"),
    "suppliers_shared": SHARED,
    "truth_shared": pair_truth("suppliers_shared"),
    "suppliers_many": MANY_NAMES,
    "truth_many": pair_truth("suppliers_many"),
    "numbered": NUMBERED,
}

SOURCES = {
    "parts_messy": ["part"],
    "suppliers_messy": ["supplier", "part"],
    "change_orders_messy": ["orders", "lineitem"],
    "numbered": ["supplier"],
}

# Derived tables that others are made of.
DERIVED = {
    "truth": ["parts_messy", "suppliers_messy", "change_orders_messy"],
    "suppliers_repeated": ["suppliers_messy"],
    "truth_repeated": ["suppliers_repeated"],
    "suppliers_arrows": ["suppliers_messy"],
    "truth_arrows": ["suppliers_arrows"],
    "suppliers_shared": ["suppliers_messy"],
    "truth_shared": ["suppliers_shared"],
    "suppliers_many": ["suppliers_messy"],
    "truth_many": ["suppliers_many"],
}


def messy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables, lazily."""
    for other in DERIVED.get(name, []):
        messy(spark, sf_dir, other).createOrReplaceTempView(other)
    for table in SOURCES.get(name, []):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(MESSY[name])


def with_messy(query: str) -> str:
    """An oracle query with the derived tables in front of it."""
    tables = ", ".join(f"{name} as ({sql})" for name, sql in MESSY.items())
    return f"with recursive {tables} {query}"


# --- the same rows as files -----------------------------------------------------


def as_csv(df: DataFrame, headers: dict[str, str], windows: bool = False) -> str:
    """Write CSV files with other headers, in UTF-8 or windows-1252; the folder."""
    path = scratch_path(df.sparkSession, "csv")
    table = df.select(*[F.col(c).alias(h) for c, h in headers.items()])
    encoding = "UTF-8"
    if windows:
        # The bytes that differ from ISO-8859-1 are written as its control codes.
        high = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
        shown, stored = bytes(high).decode("cp1252"), bytes(high).decode("latin-1")
        table = table.select(*[F.translate(c, shown, stored).alias(c) for c in table.columns])
        encoding = "ISO-8859-1"
    writer = table.write.option("header", True).option("escape", '"').option("nullValue", "N/A")
    for end in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{end}WhiteSpace", False)
    writer.option("encoding", encoding).csv(path)
    return path


def as_lines(lines: DataFrame, header: str) -> str:
    """Write text files of ready CSV lines (column ``value``), each with the header; the folder."""
    path = scratch_path(lines.sparkSession, "lines")

    def headed(batches):
        first = True
        for batch in batches:
            if first and len(batch):
                yield pd.DataFrame({"value": [header]})
                first = False
            yield batch

    lines.mapInPandas(headed, "value string").write.text(path)
    return path


ORDERS_PER_WORKBOOK = 5000


def as_workbooks(df: DataFrame) -> str:
    """Write the change orders as workbooks of a bounded number of rows; the folder."""
    folder = scratch_path(df.sparkSession, "workbooks")
    book = F.floor(F.col("o_orderkey") / ORDERS_PER_WORKBOOK)
    books = df.withColumn("book", book).groupBy("book")

    def save(batches):
        files, root = FileSystem.from_uri(folder)
        files.create_dir(root)
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield batch[["path"]]

    packed = books.applyInPandas(_workbook, "path string, content binary")
    packed.mapInPandas(save, "path string").write.format("noop").mode("overwrite").save()
    return folder


def _workbook(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("o_orderkey")
    lines = [["Change orders"], [" CO Number ", "State", "Description / Notes", "Opened", "Closed"]]
    epoch = pd.Timestamp("1899-12-30")
    for row in rows.itertuples():
        dates = [
            None if pd.isna(moment) else (moment - epoch) / pd.Timedelta(days=1)
            for moment in (row.opened_at, row.closed_at)
        ]
        lines.append([row.co_number, row.state, f" line one\nof {row.co_number} ", *dates])
    xml = []
    for number, line in enumerate(lines, 1):
        cells = []
        for at, value in enumerate(line):
            place = f"{chr(65 + at)}{number}"
            if value is None or value != value:
                continue
            if isinstance(value, float):
                cells.append(f'<c r="{place}" s="1"><v>{value!r}</v></c>')
            else:
                text = escape(str(value))
                cells.append(
                    f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'
                )
        xml.append(f'<row r="{number}">{"".join(cells)}</row>')
    return pd.DataFrame(
        {"path": [f"book-{rows['book'].iloc[0]}.xlsx"], "content": [workbook_bytes("".join(xml))]}
    )


def workbook_bytes(rows_xml: str, shared_xml: str | None = None) -> bytes:
    """The parts of a minimal workbook around the rows of its only sheet."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}">'
        '<Relationship Id="rId1" Type="sheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/>'
        '<xf numFmtId="22"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{rows_xml}'
        "</sheetData></worksheet>",
    }
    if shared_xml is not None:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{main}">{shared_xml}</sst>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()


KEYS_PER_MANIFEST = 5000


def as_manifests(truth: DataFrame) -> str:
    """Write the truth as a folder of manifest documents of bounded size.

    The keys of a category are cut into pieces by the hash of the key; a
    document holds one piece of each category, with the counts that go with it.
    """
    spark = truth.sparkSession
    path = scratch_path(spark, "manifests")
    pieces = F.lit(1 + truth.count() // KEYS_PER_MANIFEST)
    keyed = truth.where(F.col("record_key").isNotNull())
    piece = F.pmod(F.xxhash64("record_key"), pieces)
    lists = keyed.groupBy(piece.alias("piece")).pivot("category", list(fixed.MANIFEST_RECORDS)).agg(
        F.collect_list("record_key")
    )
    lists = lists.select(
        *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in fixed.MANIFEST_RECORDS]
    )
    entities = list(dict.fromkeys(entity for entity, _ in fixed.MANIFEST_COUNTS.values()))
    defects = [
        F.struct(
            *[
                F.size(category).alias(field)
                for category, (owner, field) in fixed.MANIFEST_COUNTS.items()
                if owner == entity
            ],
            F.lit("counts of this document").alias("description"),
        ).alias(entity)
        for entity in entities
    ]
    records = [F.col(c).alias(name) for c, name in fixed.MANIFEST_RECORDS.items()]
    document = F.to_json(
        F.struct(
            F.lit(2).alias("manifest_version"),
            F.struct(*defects).alias("defects"),
            F.struct(*records).alias("defect_records"),
        )
    )
    lists.select(document.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path
