"""Sinks: none overwrites what is there unless told so."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, the native format; raises where the path exists."""
    df.write.mode("errorifexists").partitionBy(*(partition_by or [])).parquet(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV parts with header in a folder."""
    df.select(*columns).write.mode("errorifexists").csv(path, header=True, escape='"')


def _csv_lines(rows: Iterator[Row], n: int) -> Iterator[tuple[str]]:
    """The first n values of each row as a CSV line without its end."""
    text = io.StringIO()
    out = csv.writer(text, lineterminator="")
    for row in rows:
        out.writerow(["" if v is None else v for v in row[:n]])
        yield (text.getvalue(),)
        text.seek(0)
        text.truncate()


def write_csv_file(df: DataFrame, path: str, columns: list[str], order: list[str], overwrite: bool = False) -> int:
    """One CSV file with byte order mark and header, rows in order; the rows written.

    Tasks write its parts to the shared folder, and the driver appends these as bytes, a buffer at a time.
    """
    with open(path, "w" if overwrite else "x", newline="", encoding="utf-8-sig") as f:
        csv.writer(f).writerow(columns)
    spark, scratch, seen = df.sparkSession, Scratch(df.sparkSession, "csv"), Observation()
    rows = df.select(*columns, *(c for c in order if c not in columns)).orderBy(*order)
    lines = spark.createDataFrame(rows.rdd.mapPartitions(partial(_csv_lines, n=len(columns))), "value string", verifySchema=False)
    lines.observe(seen, F.count(F.lit(1)).alias("n")).write.text(f"{scratch.base}/parts", compression="none", lineSep="\r\n")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch.base}/parts")
    fs = folder.getFileSystem(conf)
    parts = [(int(re.match(r"part-(\d+)", p.getPath().getName())[1]), p.getPath()) for p in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "part-*"))]
    out = jvm.java.io.FileOutputStream(os.path.abspath(path), True)
    try:
        for _, part in sorted(parts, key=lambda x: x[0]):
            source = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
    scratch.drop("parts")
    return seen.get["n"]


def write_json_document(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """The one row of df as a JSON document."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a document is one row")
    with open(path, "w" if overwrite else "x", encoding="utf-8") as f:
        json.dump(rows[0].asDict(True), f, ensure_ascii=False, indent=2, default=str)


def write_export(images: DataFrame, path: str) -> None:
    """Images and their polygons as annotation XML."""
    polygon = F.transform(
        "polygons",
        lambda p: F.struct(
            p["label"].alias("_label"),
            p["source"].alias("_source"),
            p["occluded"].cast("int").alias("_occluded"),
            p["raw_points"].alias("_points"),
            p["z_order"].alias("_z_order"),
            F.transform(F.map_entries(p["attributes"]), lambda a: F.struct(a["key"].alias("_name"), a["value"].alias("_VALUE"))).alias("attribute"),
        ),
    )
    rows = images.select(F.col("image_id").alias("_id"), F.col("name").alias("_name"), F.col("width").alias("_width"), F.col("height").alias("_height"), polygon.alias("polygon"))
    rows.orderBy("_id").write.mode("errorifexists").format("xml").option("rootTag", "annotations").option("rowTag", "image").save(path)


def label_files(lines: DataFrame) -> DataFrame:
    """(split, filename, value) with a polygon line each, by instance_index, and a final line end; from (split, stem, instance_index, line)."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("instance_index", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("split", "stem").agg(F.concat(body, F.lit("\n")).alias("value")).select("split", F.concat("stem", F.lit(".txt")).alias("filename"), "value")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write (subfolder, filename, content) below a folder all executors share; returns (filename, sha256, ok), read back from disk.

    A file that is there raises, unless it has the very content, as after a task that is run again.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sub, name, content in zip(batch["subfolder"], batch["filename"], batch["content"], strict=True):
                os.makedirs(os.path.join(folder, sub), exist_ok=True)
                path = os.path.join(folder, sub, name)
                if os.path.exists(path):
                    with open(path, "rb") as f:
                        if f.read() != content:
                            raise FileExistsError(path)
                else:
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with open(part, "wb") as f:
                        f.write(content)
                    os.replace(part, path)
                with open(path, "rb") as f:
                    got = hashlib.file_digest(f, "sha256").hexdigest()
                ok = got == hashlib.sha256(content).hexdigest()
                if not ok:
                    os.unlink(path)
                rows.append((name, got, ok))
            yield pd.DataFrame(rows, columns=["filename", "sha256", "ok"])

    return files.select("subfolder", "filename", "content").mapInPandas(put, "filename string, sha256 string, ok boolean")


def copy_verified(source: str, target: str) -> str:
    """Copy one file; raises, and removes the copy, where its hash isn't the source's."""
    if os.path.exists(target):
        raise FileExistsError(target)
    digest = lambda p: hashlib.file_digest(open(p, "rb"), "sha256").hexdigest()  # noqa: E731, SIM115
    shutil.copyfile(source, target)
    if (got := digest(target)) != digest(source):
        os.unlink(target)
        raise OSError(f"copy differs: {target}")
    return got


def write_zip(paths: list[str], target: str, level: int = 1) -> None:
    with zipfile.ZipFile(target, "x", zipfile.ZIP_DEFLATED, compresslevel=level) as archive:
        for p in sorted(paths):
            archive.write(p, os.path.basename(p))


def write_dataset_yaml(path: str, root: str, names: dict[int, str]) -> None:
    import yaml

    with open(path, "x", encoding="utf-8") as f:
        yaml.safe_dump({"path": root, "train": "images/train", "val": "images/val", "test": "images/test", "names": names}, f, sort_keys=False, allow_unicode=True)


def write_readme(path: str, title: str, facts: dict[str, object], notes: list[str] = ()) -> None:
    """A short text file with a title, named facts and notes."""
    lines = [f"# {title}", "", *(f"- {k}: {v}" for k, v in facts.items()), *("", *notes)[: 1 + len(notes) if notes else 0]]
    with open(path, "x", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def review_page(rows: list[dict], title: str) -> str:
    """An HTML table of review rows with a filter; decisions are kept by the browser as they are typed, and exported as JSON."""
    from html import escape

    keys = list(rows[0]) if rows else []
    head = "".join(f"<th>{escape(k)}</th>" for k in keys)
    body = "".join("<tr>" + "".join(f"<td>{escape(str(r[k]))}</td>" for k in keys) + f"<td><input data-row={n}></td></tr>" for n, r in enumerate(rows))
    script = "const q=document.querySelector('#q');q.oninput=()=>document.querySelectorAll('tbody tr').forEach(r=>r.hidden=!r.textContent.toLowerCase().includes(q.value.toLowerCase()));"
    script += (
        "const k='review:'+document.title,d=JSON.parse(localStorage.getItem(k)||'{}');document.querySelectorAll('[data-row]').forEach(i=>{i.value=d[i.dataset.row]||'';"
        "i.oninput=()=>{d[i.dataset.row]=i.value;localStorage.setItem(k,JSON.stringify(d));};});const h=[...document.querySelectorAll('th')].map(x=>x.textContent);"
        "document.querySelector('#save').onclick=()=>{const o=[...document.querySelectorAll('tbody tr')].map(r=>Object.fromEntries([...r.cells].map((c,n)=>[h[n],c.firstElementChild?c.firstElementChild.value:c.textContent])));"
        "const a=document.createElement('a');a.href=URL.createObjectURL(new Blob([JSON.stringify(o)],{type:'application/json'}));a.download=document.title+'.json';a.click();};"
    )
    return f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><input id=q placeholder=filter><button id=save>export</button><table><thead><tr>{head}<th>decision</th></tr></thead><tbody>{body}</tbody></table><script>{script}</script>"
