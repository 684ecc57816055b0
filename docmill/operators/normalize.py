"""Extraction payloads: checked, and turned into typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, scoring
from ..functions.text import blank_to_null, lenient_int, strip
from ..functions.transliterate import source_hash, transliterate

# Failures that a later attempt may not have, and marks for cells that a roll doesn't print.
RETRYABLE = ("MODEL_TIMEOUT", "EXTRACTION_FAILED", "INTERNAL_ERROR", "EXTRACTION_SERVICE_UNAVAILABLE")
NO_MARK, NO_WARD = "Not printed", "Not on this roll"

_TEXT = "name relative_name house_number gender section_name"
_KINDS = ("father", "husband", "mother", "other")
_RELATIVES = [f"voter_{k}_{p}_name" for k in _KINDS for p in ("first", "middle", "last")]
_RAW = ["sno", "card_index", "voter_sr_no", "serial_mark", "state_code", "ac_code", "anubhag_code", "anubhag_name", "ward_code", "roll_format", "anubhag_status", "booth_code",
        "pdf_name", "voter_first_name", "voter_middle_name", "voter_sur_name", "relation_name", *_RELATIVES]


def _struct(fields) -> str:
    return "struct<" + ",".join(f"{f}:string" for f in fields) + ">"


RECORD = (
    f"struct<source:struct<page_number:string,row_number:string>,hindi:{_struct(_TEXT.split())},english:{_struct(_TEXT.split())},"
    f"common:{_struct(['serial_number', 'epic_number', 'age', 'relationship_type', 'anubhag_code', 'section_number'])},"
    f"raw_record:struct<{','.join(f'{f}:string' for f in _RAW)},is_deleted:boolean,needs_review:boolean,review_reasons:array<string>,field_sources:map<string,string>>,confidence:string>"
)
ENVELOPE = f"struct<success:boolean,http_status:int,error:struct<code:string,message:string>,extractor_version:string,page_from:int,page_to:int,document_metadata:string,records:array<{RECORD}>>"


def _error(code: str | Column, message: str | Column, retryable: bool | Column) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(code).cast("string").alias("code"), lit(message).cast("string").alias("message"), lit(retryable).alias("retryable"))


def validated(rows: DataFrame, payload: str, page_from: str, page_to: str) -> DataFrame:
    """rows with the first error (code, message, retryable) of each payload, null for a usable one."""
    e, raw = F.from_json(payload, ENVELOPE), F.col(payload)
    bad = lambda message: _error("INVALID_RESPONSE", message, False)
    kind = lambda path: F.get_json_object(raw, path)
    code = F.coalesce(e["error"]["code"], F.lit("EXTRACTION_FAILED"))
    status = F.coalesce(e["http_status"], F.lit(200))
    outside = F.exists(e["records"], lambda r: ~F.coalesce(r["source"]["page_number"].try_cast("int").between(F.col(page_from), F.col(page_to)), F.lit(False)))
    found = (
        F.when(~F.coalesce(F.ltrim(raw).startswith("{"), F.lit(False)), bad("not an object"))
        .when(e["success"] == F.lit(False), _error(code, F.coalesce(e["error"]["message"], F.lit("Extraction failed")), code.isin(*RETRYABLE)))
        .when(status >= 500, _error("EXTRACTION_SERVICE_UNAVAILABLE", F.concat(F.lit("HTTP "), status.cast("string")), True))
        .when(status >= 400, bad(F.concat(F.lit("HTTP "), status.cast("string"))))
        .when(~e["page_from"].eqNullSafe(F.col(page_from)) | ~e["page_to"].eqNullSafe(F.col(page_to)), bad("another page range"))
        .when(e["extractor_version"].isNull() | e["records"].isNull(), bad("extractor_version or records missing"))
        .when(~F.coalesce(kind("$.document_metadata"), F.lit("{}")).startswith("{"), bad("document_metadata is no object"))
        .when(F.exists(e["records"], lambda r: F.coalesce(r["source"].isNull(), F.lit(True))), bad("a record has no source"))
        .when(outside, bad("a record's page is outside the range"))
    )
    return rows.withColumn("error", found)


def normalised_records(rows: DataFrame, payload: str) -> DataFrame:
    """One typed row per record of usable payloads (document_id, session_id, unit_id beside the payload).

    English is derived from the Hindi that is stored. A record without a page
    or a positive row number is left out; other faults are named in
    validation_errors and the record stays.
    """
    r = F.col("r")
    item = rows.select("document_id", "session_id", "unit_id", F.explode(F.from_json(payload, ENVELOPE)["records"]).alias("r"))
    item = item.select("*", lenient_int(r["source"]["page_number"]).alias("page_number"), lenient_int(r["source"]["row_number"]).alias("source_row_number")).where("page_number IS NOT NULL AND source_row_number >= 1")
    raw = lambda f: blank_to_null(r["raw_record"][f])
    hindi = lambda f: blank_to_null(r["hindi"][f])

    joined = hindi("name")
    split = names.parts(joined)
    no_parts = raw("voter_first_name").isNull() & raw("voter_middle_name").isNull() & raw("voter_sur_name").isNull()
    part = {p: F.when(no_parts, split[s]).otherwise(raw(f"voter_{p}_name")) for p, s in (("first", "first"), ("middle", "middle"), ("sur", "last"))}
    name = F.coalesce(names.join(part["first"], part["middle"], part["sur"]), joined)
    relative, gender, house = hindi("relative_name"), hindi("gender"), hindi("house_number")
    section = F.coalesce(hindi("section_name"), raw("anubhag_name"))
    format_ = F.coalesce(raw("roll_format"), F.lit("assembly"))
    age = lenient_int(r["common"]["age"])
    conf = scoring.stored_confidence(r["confidence"])
    low, high = scoring.STORED_AGE
    faults = scoring.errors(
        (~age.between(low, high), f"age outside {low}–{high}"), (conf["error"].isNotNull(), conf["error"]), (name.isNull() & blank_to_null(r["english"]["name"]).isNull(), "name missing"),
    )
    cells = {f"voter_{p}_name_{lang}": names.cell(v if lang == "hi" else transliterate(v)) for p, v in part.items() for lang in ("hi", "en")}
    cells |= {f"{c}_{lang}": names.cell(raw(c) if lang == "hi" else transliterate(raw(c))) for c in _RELATIVES for lang in ("hi", "en")}
    return item.select(
        "document_id", "session_id", F.col("unit_id").alias("extraction_unit_id"), "page_number", "source_row_number",
        lenient_int(r["common"]["serial_number"]).alias("serial_number"), blank_to_null(r["common"]["epic_number"]).alias("epic_number"),
        lenient_int(raw("sno")).alias("sno"), lenient_int(raw("card_index")).alias("card_index"), raw("voter_sr_no").alias("voter_sr_no"),
        F.coalesce(raw("serial_mark"), F.lit(NO_MARK)).alias("serial_mark"), F.coalesce(r["raw_record"]["is_deleted"], F.lit(False)).alias("is_deleted"),
        raw("state_code").alias("state_code"), raw("ac_code").alias("ac_code"), lenient_int(raw("anubhag_code")).alias("anubhag_code"), raw("anubhag_name").alias("anubhag_name"),
        F.coalesce(raw("ward_code"), F.when(format_ != "municipal_ward", NO_WARD)).alias("ward_code"), format_.alias("roll_format"), raw("anubhag_status").alias("anubhag_status"),
        raw("booth_code").alias("booth_code"), raw("pdf_name").alias("pdf_name"), F.coalesce(r["raw_record"]["needs_review"], F.lit(False)).alias("needs_review"),
        F.coalesce(r["raw_record"]["review_reasons"], F.array().cast("array<string>")).alias("review_reasons"), F.coalesce(r["raw_record"]["field_sources"], F.create_map().cast("map<string,string>")).alias("field_sources"),
        names.cell(name).alias("name_hi"), names.cell(transliterate(name)).alias("name_en"), *[v.alias(k) for k, v in cells.items()],
        names.cell(relative).alias("relative_name_hi"), names.cell(transliterate(relative)).alias("relative_name_en"),
        F.coalesce(raw("relation_name"), names.relation_printed(r["common"]["relationship_type"])).alias("relation_name"), names.relation_key(r["common"]["relationship_type"]).alias("relationship_type"),
        age.alias("age"), gender.alias("gender_hi"), F.coalesce(names.gender_english(gender), transliterate(gender)).alias("gender_en"), house.alias("house_number_hi"), transliterate(house).alias("house_number_en"),
        lenient_int(F.coalesce(blank_to_null(r["common"]["anubhag_code"]), r["common"]["section_number"])).alias("section_number"), section.alias("section_name_hi"), transliterate(section).alias("section_name_en"),
        conf["value"].cast("decimal(5,4)").alias("confidence"), scoring.record_hash(F.col("session_id"), F.col("page_number"), F.col("source_row_number")).alias("source_record_hash"),
        source_hash(name, relative, gender, section, house).alias("translit_source_hash"), (F.size(faults) == 0).alias("is_valid"), faults.alias("validation_errors"),
    )


def normalised_metadata(rows: DataFrame, payload: str) -> DataFrame:
    """Header facts per payload: Hindi as given, English derived from it or, without it, as given."""
    fields = ("state", "district", "assembly_constituency", "polling_station", "polling_station_address")
    at = lambda side, f: blank_to_null(F.get_json_object(payload, f"$.document_metadata.{side}.{f}"))
    common = lambda f: lenient_int(at("common", f))
    return rows.select(
        "document_id", "session_id", *[at("hindi", f).alias(f"{f}_hi") for f in fields], *[F.coalesce(transliterate(at("hindi", f)), strip(at("english", f))).alias(f"{f}_en") for f in fields],
        common("roll_year").alias("roll_year"), at("common", "publication_date").try_cast("date").alias("publication_date"),
        common("assembly_constituency_number").alias("assembly_constituency_number"), common("part_number").alias("part_number"),
    )
