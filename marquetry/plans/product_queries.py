"""Rules on requests, answers, masks and published rows, each with planted faults; documents, events and embeddings stand in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import geometry as G
from marquetry.functions import identity as I
from marquetry.functions import masks as K
from marquetry.functions import requests as Q
from marquetry.functions import rules as R
from marquetry.functions import text as X
from marquetry.operators import branches as B
from marquetry.operators.discover import prompt_metadata as told_metadata
from marquetry.plans.mask_queries import _PX, SIDE, _masks
from marquetry.plans.tables import table

# A published item; <S>, <M>, <F> and <N> stand for the row's digests and its place.
_FINAL = '{"area_fraction":0.25,"sha256":"<M>"}'
_CHECK = '{"area_fraction":0.001,"detector":{"backend":"d"},"enabled":true,"pass":true,"queries":["robot"],"threshold":0.002}'
_QUALITY = '{"max_residual_area_fraction":0.002,"outside_mask_unchanged":true,"residual_check_enabled":true,"residual_mask_area_fraction":0.001}'
_HOW = f'{{"final_mask":{_FINAL},"inpainter":{{"backend":"b"}},"operation":"{R.OPERATION}","quality_control":{_QUALITY},"residual_qa":{_CHECK},"segmenter":{{"backend":"s"}}}}'
_ITEM = (
    f'{{"height":12,"mask_area_fraction":0.25,"mask_sha256":"<M>","provenance":{_HOW},"reference_id":"sha256:<S>","reference_kind":"{R.KIND}","reference_path":"Reference/episode_<N>/reference_00.jpg",'
    f'"scope":"{R.SCOPE}","sha256":"<S>","source_frame_index":0,"source_frame_sha256":"<F>","source_view":"camera_head","width":16}}'
)
#: (what stands in a sound item, what stands there instead, rules broken by the published item, first rule broken by a fresh result).
FAULTS = [
    ("", "", "", None),
    ('"scope":"environment",', "", "missing fields", "scope"),
    ('"width":16', '"width":16,"x":1', "extra fields", None),
    ('"sha256":"<S>","source', '"sha256":"<S>0","source', "sha256, id is not the digest, image digest", "identity"),
    ('"source_frame_index":0', '"source_frame_index":1', "source frame", "source frame"),
    ('"source_frame_index":0', '"source_frame_index":false', "source frame", "source frame"),
    ("camera_head", "camera_left", "view", None),
    ('"environment"', '"object"', "scope", "scope"),
    ('"robot_removed_scene"', '"crop"', "kind", "kind"),
    ('"<F>"', '"<F>g"', "source_frame_sha256", None),
    ('"mask_sha256":"<M>"', '"mask_sha256":"zz"', "mask_sha256, final mask differs", "final mask differs"),
    ('"width":16', '"width":0', "width, geometry, image size", "image size"),
    ('"height":12', '"height":12.5', "height, geometry", "image size"),
    ('"width":16', '"width":17', "geometry, image size", "image size"),
    ('"mask_area_fraction":0.25', '"mask_area_fraction":1.0', "mask area, final mask differs", "final mask differs"),
    ('"mask_area_fraction":0.25', '"mask_area_fraction":true', "mask area, final mask differs", "final mask differs"),
    (_HOW, "{}", "provenance", "provenance"),
    (R.OPERATION, "painting", "operation", "operation"),
    ('{"backend":"s"}', "{}", "segmenter", "segmenter"),
    ('{"backend":"b"}', "null", "inpainter", "inpainter"),
    (_FINAL, "null", "final mask", "final mask"),
    (_FINAL, _FINAL.replace("0.25", "0.26"), "final mask differs", "final mask differs"),
    ('"outside_mask_unchanged":true', '"outside_mask_unchanged":false', "outside changed", "outside changed"),
    (_CHECK, "null", "residual check", "residual check"),
    ('"queries":["robot"],', "", "residual fields", "residual fields"),
    ('"enabled":true,"pass"', '"enabled":1,"pass"', "residual enabled, residual differs", "residual enabled"),
    ('"detector":{"backend":"d"}', '"detector":null', "residual detector", "residual detector"),
    ('["robot"]', "[]", "residual queries", "residual queries"),
    ('["robot"]', '["robot"," "]', "residual queries", "residual queries"),
    ('"area_fraction":0.001,"detector"', '"area_fraction":2,"detector"', "residual metrics", "residual metrics"),
    ('"threshold":0.002', '"threshold":"0.002"', "residual metrics", "residual metrics"),
    ('"pass":true', '"pass":false', "residual failed", "residual failed"),
    ('"area_fraction":0.001,"detector"', '"area_fraction":0.01,"detector"', "residual failed, residual differs", "residual failed"),
    ('"residual_mask_area_fraction":0.001', '"residual_mask_area_fraction":0.0015', "residual differs", "residual differs"),
    ("reference_00.jpg", "reference_01.jpg", "path", None),
    ("", "", "unreadable image", "identity"),
    ("", "", "image digest", "identity"),
    ("", "", "not a JPEG", None),
    ("", "", "not decodable", "not decodable"),
    ("", "", "image size", "image size"),
    ("", "", "", "no masks"),
]
_N = len(FAULTS)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, v (the item), and what is known of its picture; the fault goes by doc_id."""
    k = F.col("doc_id") % _N
    item = F.lit(_ITEM)
    for number, (sound, broken, _, _) in enumerate(FAULTS):
        if sound:
            item = F.when(k == number, F.lit(_ITEM.replace(sound, broken, 1))).otherwise(item)
    digest = lambda name: F.sha2(F.concat(F.lit(name), F.coalesce("text", F.lit(""))), 256)
    for mark, value in (("<S>", digest("s")), ("<M>", digest("m")), ("<F>", digest("f")), ("<N>", F.format_string("%06d", "doc_id"))):
        item = F.replace(item, F.lit(mark), value)
    found = F.when(k == 35, None).when(k == 36, digest("other")).otherwise(digest("s"))
    head = F.when(k == 37, F.lit(b"\x89P")).otherwise(F.lit(b"\xff\xd8"))
    height = F.when(k == 38, -1).when(k == 39, 11).otherwise(12)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.parse_json(item).alias("v"), found.alias("found"), head.alias("head"), height.alias("height"))
    return rows.withColumns({"width": F.lit(16), "masks": F.when(k == 40, 0).otherwise(1)})


def published_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that published rows and their pictures break."""
    v = F.col("v")
    pictures = R.picture_rules(v, F.col("found"), F.col("head"), F.col("height"), F.col("width"))
    path = F.format_string("Reference/episode_%06d/reference_00.jpg", "doc_id")
    broken = R.published(v, F.lit("camera_head"), F.lit(16), F.lit(12), path, pictures)
    return _items(spark, sf_dir).select("doc_id", F.array_join(broken, ", ").alias("violations"))


def result_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that a fresh result breaks."""
    broken = R.first_broken(F.col("v"), F.col("masks"), F.col("found"), F.col("height"), F.col("width"))
    return _items(spark, sf_dir).select("doc_id", broken.alias("violation"))


def _cases(column: int) -> str:
    told = [(k, f[column]) for k, f in enumerate(FAULTS) if f[column] is not None]
    return f"case doc_id % {_N} " + " ".join(f"when {k} then '{v}'" for k, v in told) + " end"


def request_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes that answer another request than asked; the fault goes by doc_id."""
    k = F.col("doc_id") % 7
    path = F.format_string("Reference/episode_%06d/reference_00.jpg", "doc_id")
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), F.col("source").alias("view"), F.lit(12).alias("height"), F.col("n_chars").alias("width"), F.sha2("text", 256).alias("source_sha256"), path.alias("path"), k.alias("k"))
    told = asked.select(
        F.when(F.col("k") == 1, F.concat(F.lit("x"), "sample_id")).otherwise(F.col("sample_id")).alias("sample_id"), F.when(F.col("k") == 2, "other").otherwise(F.col("view")).alias("view"), F.when(F.col("k") == 3, 13).otherwise(12).alias("height"), "width",
        F.when(F.col("k") == 4, None).otherwise(F.col("source_sha256")).alias("source_sha256"), F.when(F.col("k") == 5, "a.jpg").otherwise(F.col("path")).alias("path"),
    )
    return B.mismatch(asked.drop("k"), told)


def frame_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of frame numbers that cannot be used: one short, two swapped, moved by one, beyond the end, or repeated."""
    k, f, n = F.col("doc_id") % 6, F.col("f"), F.col("n_chars")
    given = (
        F.when(k == 1, F.slice(f, 1, 7))
        .when(k == 2, F.concat(F.array(f[1], f[0]), F.slice(f, 3, 6)))
        .when(k == 3, F.transform(f, lambda x: x + 1))
        .when(k == 4, F.concat(F.slice(f, 1, 7), F.array(n)))
        .when(k == 5, F.concat(F.slice(f, 1, 7), F.array(f[6])))
        .otherwise(f)
    )
    rows = table(spark, sf_dir, "documents").withColumn("f", G.uniform_frames(F.col("n_chars")))
    return rows.select("doc_id", Q.frame_list_broken(given, n).alias("reason"))


def request_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of each request, as digest and length, and its captions."""
    metadata = F.concat(F.lit('{"lang":"'), F.coalesce("lang", F.lit("")), F.lit('"}'))
    rows = table(spark, sf_dir, "documents").filter("n_chars >= 8").withColumn("header", Q.header_text(F.col("source"), metadata))
    captions = F.array_join(Q.captions(G.uniform_frames(F.col("n_chars")), F.lit(25.0)), "|")
    return rows.select("doc_id", F.sha2("header", 256).alias("sha256"), F.length("header").alias("characters"), captions.alias("captions"))


def response_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an answer holds a sentence of the schema: plain, fenced, with a further field, no text, empty, or cut off."""
    k = F.col("event_id") % 6
    good = F.concat(F.lit('{"prompt": "'), "event_type", F.lit('"}'))
    raw = (
        F.when(k == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(k == 2, F.concat(F.lit('{"note": 1, "prompt": "'), "event_type", F.lit('"}')))
        .when(k == 3, F.lit('{"prompt": 3}'))
        .when(k == 4, F.lit('{"prompt": "  "}'))
        .when(k == 5, F.substring(good, 1, 14))
        .otherwise(good)
    )
    return table(spark, sf_dir, "events").select("event_id", Q.payload_status(raw).alias("status"))


def mask_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays that are no removal masks: of another size, with other values, or empty."""
    k, mask = F.col("vec_id") % 4, F.col("mask")
    given = F.when(k == 1, F.concat(F.array(F.lit(7)), F.slice(mask, 2, 63))).when(k == 2, F.slice(mask, 1, 63)).when(k == 3, F.transform(mask, lambda x: x * 255)).otherwise(mask)
    rows = _masks(spark, sf_dir).withColumn("given", given)
    return rows.select("vec_id", K.mask_broken(F.col("given"), F.lit(SIDE), F.lit(SIDE)).alias("reason"), K.binary_values(F.col("given")).alias("binary"))


def prediction_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted masks whose box is not theirs."""
    k, mask = F.col("vec_id") % 5, F.col("mask")
    tight = K.bbox(mask, SIDE)
    box = F.when(k == 1, F.array(tight[0], tight[1], tight[2], tight[3] + 1)).when(k == 2, F.array(tight[2], tight[1], tight[0], tight[3])).otherwise(tight)
    given = F.when(k == 3, F.slice(mask, 1, 63)).when(k == 4, F.transform(mask, lambda _: F.lit(0))).otherwise(mask)
    return _masks(spark, sf_dir).select("vec_id", K.prediction_broken(given, box, SIDE, SIDE).alias("reason"))


def mask_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean probability of positive logits; the vectors stand in for logits."""
    logits = F.transform("embedding", lambda x: x.cast("double") * 90)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(K.confidence(logits), 9).alias("confidence"))


def shape_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures that can go to a model together: those of one padded shape."""
    side = lambda x: x + G.padding(x, 8)
    rows = table(spark, sf_dir, "part").select(side(F.col("p_size").cast("bigint") + 40).alias("height"), side(F.length("p_name").cast("bigint") + 40).alias("width"))
    return rows.groupBy("height", "width").agg(F.count("*").alias("pictures"))


def vocabulary_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that can go to a detector together: those whose queries are equal but for case and marks."""
    word = X.casefold(X.clean_query(F.when(F.col("turn") % 2 == 0, F.upper("role")).otherwise(F.concat(F.lit(" "), "role", F.lit(". ")))))
    return table(spark, sf_dir, "conversations").groupBy(word.alias("vocabulary")).agg(F.count("*").alias("requests"), F.min(F.struct("conv_id", "turn")).alias("first")).select("vocabulary", "requests", F.col("first.conv_id").alias("conv_id"), F.col("first.turn").alias("turn"))


def unique_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which nobody speaks twice."""
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    return lists.select("conv_id", G.unique(F.col("roles")).alias("unique"))


def near_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality of decoded areas, up to one in 10^5 of the second and 10^-8."""
    x, k = F.col("p_retailprice"), F.col("p_partkey") % 6
    y = F.when(k == 1, x * 1.000005).when(k == 2, x * 1.0001).when(k == 3, F.lit(float("nan"))).when(k == 4, F.lit(float("inf"))).otherwise(x)
    pair = G.near_to(F.when(k == 5, F.lit(5e-9)).otherwise(x), F.when(k == 5, F.lit(0.0)).otherwise(y))
    return table(spark, sf_dir, "part").select("p_partkey", pair.alias("near"))


def prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of a request: task, metadata and every frame's number, time and digest."""
    frames = F.transform(G.uniform_frames(F.col("n_chars")), lambda f: F.struct(f.cast("int").alias("index"), (f / 4).alias("seconds"), F.concat(F.lit("frame"), f.cast("string")).cast("binary").alias("jpeg")))
    told = I.prompt_fingerprint("generator", F.col("source"), F.lit("{}"), frames)
    return table(spark, sf_dir, "documents").filter("n_chars >= 8").select("doc_id", told.alias("fingerprint"))


def scene_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of a scene: the raster's shape and bytes, and every setting."""
    told = I.scene_fingerprint("extractor", F.col("doc_id").cast("string"), F.col("source"), F.lit(12), F.col("n_chars"), F.coalesce("text", F.lit("")).cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", told.alias("fingerprint"))


def prompt_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a request tells beside its task; parts that are missing are left out."""
    k = F.col("doc_id") % 4
    robot: Column = F.when(k != 0, F.col("source"))
    rows = table(spark, sf_dir, "documents").select("doc_id", robot.alias("robot_type"), F.when(k == 1, "[]").otherwise('[{"a":1}]').alias("subtasks"), F.when(k == 2, "{}").otherwise('{"note":"x"}').alias("supplemental"))
    return rows.select("doc_id", told_metadata().alias("metadata"))


def checkpoint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held products count only under their key and with their digest; the fault goes by doc_id."""
    k = F.col("doc_id") % 3
    held = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(F.col("doc_id").alias("sample_id"), F.concat(F.when(k == 1, "old").otherwise("key"), F.lit("-"), "doc_id").alias("cache_key"), "text", F.when(k == 2, F.sha2(F.lit("x"), 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    valid = held.filter(F.sha2("text", 256) == F.col("sha256")).select("sample_id", "cache_key", F.lit(True).alias("hit"))
    asked = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"), F.concat(F.lit("key-"), "doc_id").alias("cache_key"))
    return asked.join(valid, ["sample_id", "cache_key"], "left").groupBy(F.coalesce("hit", F.lit(False)).alias("hit")).agg(F.count("*").alias("n"))


def decode_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame 0 comes from the bundle decoded for the sentence where there is one (documents with a label), else from its own decoding."""
    bundles = table(spark, sf_dir, "labels").select("doc_id", F.lit("bundle").alias("shared"))
    wanted = table(spark, sf_dir, "documents").select("doc_id").join(bundles, "doc_id", "left")
    return wanted.groupBy(F.coalesce("shared", F.lit("own")).alias("frame0")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        published_rules, result_rules, request_mismatch, frame_lists, request_text, response_payload, mask_validity, prediction_validity, mask_confidence, shape_batches, vocabulary_batches,
        unique_lists, near_values, prompt_inputs, scene_inputs, prompt_metadata, checkpoint_lookup, decode_sharing,
    )
}
_HEADER = Q.HEADER.replace("'", "''") + '{"robot_metadata":{"lang":"'
_TAIL = (f"{Q.FOOTER}\n\n{Q.schema_text()}").replace("'", "''")
_EIGHT = "cast(round_even(k * (n_chars - 1) / 7.0, 0) as bigint)"
ORACLES = {
    "published_rules": f"select doc_id, {_cases(2)} as violations from documents",
    "result_rules": f"select doc_id, {_cases(3)} as violation from documents",
    "request_mismatch": """select case when doc_id % 7 = 1 then 'x' else '' end || doc_id as sample_id, case doc_id % 7 when 1 then 'sample' when 2 then 'view' when 3 then 'geometry' when 4 then 'source' else 'path' end as problem
  from documents where doc_id % 7 between 1 and 5""",
    "frame_lists": """select doc_id, case when n_chars < 8 then 'count' else case doc_id % 6 when 1 then 'count' when 2 then 'order' when 3 then 'first' when 4 then 'last' when 5 then 'order' end end as reason from documents""",
    "request_text": f"""with heads as (select doc_id, n_chars, '{_HEADER}' || coalesce(lang, '') || '"}},"task_description":"' || source || '"}}' || '{_TAIL}' as header from documents where n_chars >= 8)
select doc_id, sha256(header) as sha256, cast(length(header) as int) as characters,
  (select string_agg(printf('FRAME %d/8: index=%d, time=%.3fs', k + 1, {_EIGHT}, {_EIGHT} / 25.0::double), '|' order by k) from (select unnest(range(8)) as k)) as captions from heads""",
    "response_payload": "select event_id, case event_id % 6 when 2 then 'schema' when 3 then 'schema' when 4 then 'schema' when 5 then 'json' else 'ok' end as status from events",
    "mask_validity": _PX + """select vec_id, case vec_id % 4 when 1 then 'values' when 2 then 'shape' else case when area = 0 then 'empty' end end as reason, vec_id % 4 <> 1 as binary from sums""",
    "prediction_validity": _PX + """select vec_id, case when vec_id % 5 = 3 then 'size' when vec_id % 5 = 4 or area = 0 then 'empty' when vec_id % 5 = 1 then case when y1 = 8 then 'box outside' else 'box not tight' end
  when vec_id % 5 = 2 then 'box outside' end as reason from sums""",
    "mask_confidence": """select vec_id, (select round(avg(1 / (1 + exp(-least(x, 20.0::double)))), 9) from (select unnest(embedding)::double * 90 as x) where x > 0) as confidence from embeddings""",
    "shape_batches": """select ((p_size + 47) // 8 * 8)::bigint as height, ((length(p_name) + 47) // 8 * 8)::bigint as width, count(*) as pictures from part group by 1, 2""",
    "vocabulary_batches": """select lower(role) as vocabulary, count(*) as requests, arg_min(conv_id, (conv_id, turn)) as conv_id, arg_min(turn, (conv_id, turn)) as turn from conversations group by 1""",
    "unique_lists": "select conv_id, count(role) = count(distinct role) as unique from conversations group by 1",
    "near_values": "select p_partkey, p_partkey % 6 in (0, 1, 5) as near from part",
    "prompt_inputs": f"""select doc_id, 'sha256:' || sha256('{{"frames":[' || (select string_agg('{{"index":' || {_EIGHT} || ',"jpeg_sha256":"' || sha256('frame' || {_EIGHT}) || '","seconds":' || ({_EIGHT} / 4.0::double)::varchar || '}}', ',' order by k)
  from (select unnest(range(8)) as k)) || '],"generator":"generator","metadata":"{{}}","schema":"prompt-input","task":"' || source || '"}}') as fingerprint from documents where n_chars >= 8""",
    "scene_inputs": """select doc_id, 'sha256:' || sha256('uint8(12,' || n_chars || ',3)' || coalesce(text, '') || '{"extractor":"extractor","sample_id":"' || doc_id || '","source_frame_index":0,"view":"' || source || '"}') as fingerprint from documents""",
    "prompt_metadata": """select doc_id, '{' || array_to_string(list_filter([case when doc_id % 4 <> 0 then '"robot_type":"' || source || '"' end, case when doc_id % 4 <> 1 then '"subtasks":[{"a":1}]' end,
  case when doc_id % 4 <> 2 then '"supplemental_metadata":{"note":"x"}' end], lambda x: x is not null), ',') || '}' as metadata from documents""",
    "checkpoint_lookup": "select doc_id % 3 = 0 and l.doc_id is not null as hit, count(*) as n from documents left join (select distinct doc_id from labels) l using (doc_id) group by 1",
    "decode_sharing": "select case when doc_id in (select doc_id from labels) then 'bundle' else 'own' end as frame0, count(*) as n from documents group by 1",
}
