"""Directories of evidence: whether one is complete, what its envelopes say, and the ids under which it is published.

A directory is a set of rows (directory, sweep_id, path, content), read from
files by ``read_directories``. Its root manifest lists the artifacts with
their lengths and hashes, a candidate bundle and a barrier evaluation are
envelopes around payloads, and ``transitions.jsonl`` is the chain of states.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import json_text
from tidemark.functions import rules as R
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import staged

#: Names and versions that evidence must bear (fixed values).
ROOT, TRANSITIONS, CANDIDATE, BARRIER = "root-manifest.json", "transitions.jsonl", "candidate-bundle", "barrier-evaluation"
EVIDENCE_VERSION, CANONICAL_VERSION = "active-listings-evidence-v1", "canonical-json-v1"
CANDIDATE_ENVELOPE, BARRIER_ENVELOPE = "candidate-bundle-envelope-v3", "barrier-evaluation-envelope-v2"
CANDIDATE_MODEL, GENERATION_MODEL = "active-listings-offline-candidate-v3", "active-listings-offline-generation-barrier-v2"
STATEMENT = "BARRIER PREREQUISITES ONLY. NO ORDER VERIFICATION. NO DEACTIVATION AUTHORITY."
#: States of a generation and those that may follow (fixed values).
EDGES = {"OPEN": ("TRANSPORT_COMPLETE", "ABORTED"), "TRANSPORT_COMPLETE": ("CATCHING_UP", "ABORTED"), "CATCHING_UP": ("VERIFIED", "ABORTED")}

_HASH, _UUID = "^[0-9a-f]{64}$", "^(?i)[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
_ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?Z$"
_MANIFEST = (
    "sweepId string, modelVersion string, snapshotStartedAt string, policyHash string, scope struct<chain: string, collection: string, contract: string, endpoint: string>, sourceProvenance map<string, string>, evidenceSchemaVersion string, "
    "canonicalizationVersion string, artifacts array<struct<artifactType: string, artifactId: string, sweepId: string, relativePath: string, schemaVersion: string, contentHash: string, byteLength: bigint>>, writerProvenance map<string, string>, semanticStatement string, rootContentHash string"
)
_TRANSITION = "sweepId string, sequence bigint, fromState string, toState string, recordedAt string"
_ENVELOPE = (
    "artifactType string, artifactId string, artifactSchemaVersion string, sweepId string, candidateModelVersion string, generationModelVersion string, sourceProvenance map<string, string>, candidateBundleHash string, generationResultHash string, candidateArtifactHash string, "
    "state string, fenceOutcome string, semanticStatement string, authorityGranted boolean, deactivationAuthorityGranted boolean"
)
_CANDIDATES = "array<struct<orderHash: string, classification: string>>"
_ADVANCED = "array<struct<orderHash: string, sourceClassification: string>>"

#: What makes a root manifest worthless, the first that holds; columns as in ``_MANIFEST``, flags of its artifacts beside them.
MANIFEST_ERRORS: R.Rules = (
    (
        "INVALID_ROOT_MANIFEST",
        f"NOT coalesce(evidenceSchemaVersion = '{EVIDENCE_VERSION}' AND canonicalizationVersion = '{CANONICAL_VERSION}' AND m_sweep = sweep_id AND semanticStatement = '{STATEMENT}' AND matches(rootContentHash, '{_HASH}') AND has_artifacts AND has_writer, false)",
    ),
    ("ROOT_HASH_MISMATCH", "NOT coalesce(rootContentHash = real_hash, false)"),
    ("INVALID_GENERATION_IDENTITY", f"NOT coalesce(matches(m_sweep, '{_UUID}') AND trim(modelVersion) <> '' AND matches(snapshotStartedAt, '{_ISO}') AND trim(policyHash) <> '', false)"),
    ("INVALID_GENERATION_SCOPE", "NOT coalesce(trim(chain) <> '' AND trim(collection) <> '' AND matches(contract, '^0x(?i)[0-9a-f]{40}$') AND matches(endpoint, '^https://'), false)"),
    ("INVALID_PROVENANCE", "NOT coalesce(sound_provenance, false)"),
    ("INVALID_ARTIFACT_REF", "bad_refs > 0"), ("DUPLICATE_ARTIFACT_IDENTITY", "identities < refs"), ("INVALID_ARTIFACT_PATH", "bad_paths > 0"),
)
#: What is wrong with the files of a directory whose manifest is sound.
DIRECTORY_REASONS: R.Rules = (
    ("PARTIAL_ARTIFACT_PRESENT", "partial > 0"), ("UNREGISTERED_ARTIFACT", "unregistered > 0"), ("ARTIFACT_HASH_MISMATCH", "differing > 0"), ("DECLARED_ARTIFACT_MISSING", "lost > 0"),
    ("TRANSITION_HISTORY_MISSING", "NOT declares_history"), ("INVALID_TRANSITION_HISTORY", "declares_history AND NOT sound_history"),
)
#: Envelopes that contradict the manifest or each other.
ENVELOPE_REASONS: R.Rules = (
    (
        "CANDIDATE_ENVELOPE_MISMATCH",
        f"NOT coalesce(c_type = '{CANDIDATE}' AND c_id = '{CANDIDATE}' AND c_sweep = sweep_id AND c_model = '{CANDIDATE_MODEL}' AND NOT c_granted AND c_schema = '{CANDIDATE_ENVELOPE}' AND c_provenance = provenance AND c_hash = c_real, false)",
    ),
    (
        "BARRIER_ENVELOPE_MISMATCH",
        f"NOT coalesce(b_type = '{BARRIER}' AND b_id = '{BARRIER}' AND b_sweep = sweep_id AND b_model = '{GENERATION_MODEL}' AND NOT b_granted AND b_schema = '{BARRIER_ENVELOPE}' AND b_statement = '{STATEMENT}' AND b_candidate = c_content_hash AND b_hash = b_real AND b_provenance = provenance AND b_state = b_real_state AND b_fence = b_real_fence, false)",
    ),
    ("CANDIDATE_GENERATION_HANDOFF_MISMATCH", "NOT coalesce(candidates = advanced, false)"),
)


def read_directories(spark: SparkSession, root: str) -> DataFrame:
    """(directory, sweep_id, path, content) of all files below ``root``, where every directory bears its sweep's id."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.element_at(F.split("path", f"{root.rstrip('/').rpartition('/')[2]}/", 2), 2)
    directory = F.substring_index(below, "/", 1)
    return files.select(directory.alias("directory"), directory.alias("sweep_id"), F.regexp_replace(below, "^[^/]*/", "").alias("path"), F.decode("content", "UTF-8").alias("content"))


def _sorted_text(pairs: Column) -> Column:
    """A map as text that does not hang on the order of its entries."""
    return F.to_json(F.array_sort(F.map_entries(pairs)))


def _is_sound_path(path: Column) -> Column:
    return path.isNotNull() & (path != "") & ~path.rlike(r"^([\\/]|[A-Za-z]:[\\/])") & ~F.array_contains(F.split(path, r"[\\/]+"), "..")


def _manifests(files: DataFrame) -> DataFrame:
    m = F.from_json("content", _MANIFEST)
    found = files.where(F.col("path") == ROOT).select("directory", "sweep_id", "content", m.alias("m"), json_text.hash_without("content", F.lit("rootContentHash")).alias("real_hash"))
    sound = F.forall(F.map_entries("m.sourceProvenance"), lambda e: (F.trim(e["key"]) != "") & F.coalesce(e["value"].rlike(_HASH), F.lit(False))) & (F.size("m.sourceProvenance") > 0)
    plain = ["evidenceSchemaVersion", "canonicalizationVersion", "semanticStatement", "rootContentHash", "modelVersion", "snapshotStartedAt", "policyHash", "artifacts"]
    return found.select(
        "directory", "sweep_id", "real_hash", F.col("m.sweepId").alias("m_sweep"), *(f"m.{c}" for c in plain), "m.scope.*", F.col("m.artifacts").isNotNull().alias("has_artifacts"),
        F.col("m.writerProvenance").isNotNull().alias("has_writer"), sound.alias("sound_provenance"), _sorted_text(F.col("m.sourceProvenance")).alias("provenance"),
    )


def _sound_histories(files: DataFrame) -> DataFrame:
    """Directories whose transitions lead from OPEN, one numbered step after another, along the allowed edges."""
    lines = files.where(F.col("path") == TRANSITIONS).select("directory", "sweep_id", F.posexplode(F.filter(F.split("content", "\n"), lambda x: x != "")).alias("at", "line"))
    step = F.from_json("line", _TRANSITION)
    before = F.coalesce(F.lag("t.toState").over(Window.partitionBy("directory").orderBy("at")), F.lit("OPEN"))
    steps = lines.withColumn("t", step).withColumn("before", before)
    allowed = reduce(Column.__or__, ((F.col("t.fromState") == state) & F.col("t.toState").isin(*following) for state, following in EDGES.items()))
    sound = (F.col("t.sweepId") == F.col("sweep_id")) & (F.col("t.sequence") == F.col("at") + 1) & (F.col("t.fromState") == F.col("before")) & allowed & F.col("t.recordedAt").rlike(_ISO)
    broken = steps.groupBy("directory").agg(F.bool_and(F.coalesce(sound, F.lit(False))).alias("sound_history"))
    every = files.where(F.col("path") == TRANSITIONS).select("directory")
    return every.join(broken, "directory", "left").select("directory", F.coalesce("sound_history", F.lit(True)).alias("sound_history"))


def directory_status(files: DataFrame) -> DataFrame:
    """(directory, sweep_id, status, reasons, provenance, root_hash): COMPLETE, INCOMPLETE without a manifest, or else CORRUPT.

    An unreadable manifest is told alone, by its first fault; behind a sound
    one, all faults of the files are. Every file is hashed once, and meets the
    manifest's list by directory and path.
    """
    hashed = files.select("directory", "path", F.sha2(F.col("content").cast("binary"), 256).alias("hash"), F.octet_length("content").alias("length"))
    manifests = _manifests(files)
    a = F.col("a")
    refs = manifests.select("directory", F.col("sweep_id"), F.explode("artifacts").alias("a")).select(
        "directory", F.concat_ws(":", a["artifactType"], a["artifactId"]).alias("identity"), a["relativePath"].alias("path"), a["contentHash"].alias("declared"), a["byteLength"].alias("bytes"),
        F.coalesce((a["sweepId"] == F.col("sweep_id")) & (F.trim(a["artifactType"]) != "") & (F.trim(a["artifactId"]) != "") & (F.trim(a["schemaVersion"]) != "") & a["contentHash"].rlike(_HASH) & (a["byteLength"] >= 0), F.lit(False)).alias("sound"),
        _is_sound_path(a["relativePath"]).alias("sound_path"),
    )
    lists = refs.groupBy("directory").agg(
        F.count(F.lit(1)).alias("refs"), F.count_distinct("identity").alias("identities"), F.count_if(~F.col("sound")).alias("bad_refs"), F.count_if(~F.col("sound_path")).alias("bad_paths"), F.bool_or(F.col("path") == TRANSITIONS).alias("declares_history"),
    )
    both = hashed.where(F.col("path") != ROOT).join(refs.select("directory", "path", "declared", "bytes"), ["directory", "path"], "full")
    met = both.groupBy("directory").agg(
        F.count_if(F.col("path").endswith(".tmp")).alias("partial"), F.count_if(F.col("declared").isNull()).alias("unregistered"), F.count_if(F.col("hash").isNull()).alias("lost"),
        F.count_if((F.col("hash") != F.col("declared")) | (F.col("length") != F.col("bytes"))).alias("differing"),
    )
    known = files.groupBy("directory").agg(F.first("sweep_id").alias("sweep_id"))
    whole = known.join(manifests.drop("sweep_id", "artifacts").withColumn("there", F.lit(True)), "directory", "left").join(lists, "directory", "left").join(met, "directory", "left").join(_sound_histories(files), "directory", "left")
    whole = whole.na.fill(0, ["refs", "identities", "bad_refs", "bad_paths", "partial", "unregistered", "lost", "differing"]).na.fill(False, ["declares_history", "sound_history"])
    error = R.first(MANIFEST_ERRORS, None)
    reasons = F.when(F.col("there").isNull(), "ROOT_MANIFEST_MISSING").when(error.isNotNull(), error).otherwise(R.reasons(DIRECTORY_REASONS))
    status = F.when(F.col("there").isNull(), "INCOMPLETE").when(F.col("reasons") != "", "CORRUPT").otherwise("COMPLETE")
    return whole.withColumn("reasons", reasons).select("directory", "sweep_id", status.alias("status"), "reasons", "provenance", F.col("rootContentHash").alias("root_hash"))


def _envelope(files: DataFrame, kind: str, prefix: str) -> DataFrame:
    """One envelope of each directory, its columns prefixed; the payload's own hash is worked out again."""
    e = F.from_json("content", _ENVELOPE)
    own = files.where(F.col("path") == f"{kind}.json").withColumn("e", e).withColumn("payload", F.get_json_object("content", "$.payload"))
    granted, model = ("authorityGranted", "candidateModelVersion") if kind == CANDIDATE else ("deactivationAuthorityGranted", "generationModelVersion")
    columns = {
        "type": F.col("e.artifactType"), "id": F.col("e.artifactId"), "sweep": F.col("e.sweepId"), "model": F.col(f"e.{model}"), "granted": F.col(f"e.{granted}"), "schema": F.col("e.artifactSchemaVersion"), "provenance": _sorted_text(F.col("e.sourceProvenance")),
        "real": json_text.canonical_hash("payload"), "content_hash": F.sha2(F.col("content").cast("binary"), 256),
    }
    if kind == CANDIDATE:
        columns |= {"hash": F.col("e.candidateBundleHash")}
        orders = F.from_json(F.get_json_object("payload", "$.orders"), _CANDIDATES)
        extra = [F.array_sort(F.transform(orders, lambda o: F.concat_ws("\0", o["orderHash"], o["classification"]))).alias("candidates")]
    else:
        columns |= {"hash": F.col("e.generationResultHash"), "statement": F.col("e.semanticStatement"), "candidate": F.col("e.candidateArtifactHash"), "state": F.col("e.state"), "fence": F.col("e.fenceOutcome")}
        columns |= {"real_state": F.get_json_object("payload", "$.state"), "real_fence": F.get_json_object("payload", "$.finalFence.outcome")}
        orders = F.from_json(F.get_json_object("payload", "$.candidateAdvancement"), _ADVANCED)
        extra = [F.array_sort(F.transform(orders, lambda o: F.concat_ws("\0", o["orderHash"], o["sourceClassification"]))).alias("advanced")]
    return own.select("directory", *(c.alias(f"{prefix}_{n}") for n, c in columns.items()), *extra)


def reconstructed(files: DataFrame, expected: DataFrame) -> DataFrame:
    """(directory, status, reasons, root_hash, candidate_hash, barrier_hash): VALID, INCOMPLETE, CORRUPT or MISMATCHED.

    ``expected`` (directory, expected_sweep, expected_provenance) says whose
    evidence a directory should be. Hashes are told of valid evidence only.
    """
    told = directory_status(files).join(expected, "directory").join(_envelope(files, CANDIDATE, "c"), "directory", "left").join(_envelope(files, BARRIER, "b"), "directory", "left")
    strange = (F.col("sweep_id") != F.col("expected_sweep")) | ~F.col("provenance").eqNullSafe(_sorted_text(F.col("expected_provenance")))
    absent = F.col("c_type").isNull() | F.col("b_type").isNull()
    found = F.when(F.col("status") != "COMPLETE", F.col("reasons")).when(strange, "INTEGRATION_PROVENANCE_MISMATCH").when(absent, "INTEGRATION_ARTIFACT_MISSING").otherwise(R.reasons(ENVELOPE_REASONS))
    status = F.when(F.col("status") != "COMPLETE", F.col("status")).when(strange, "MISMATCHED").when(absent, "INCOMPLETE").when(found != "", "MISMATCHED").otherwise("VALID")
    valid = lambda c: F.when(status == "VALID", F.col(c))
    return told.select("directory", status.alias("status"), found.alias("reasons"), valid("root_hash").alias("root_hash"), valid("c_content_hash").alias("candidate_hash"), valid("b_content_hash").alias("barrier_hash"))


def canonical_object(**members: str) -> str:
    """SQL text of an object in canonical form from SQL texts of its members' values; for strings that need no escapes."""
    inner = " || ',' || ".join(f"""'"{name}":' || {value}""" for name, value in sorted(members.items()))
    return f"('{{' || {inner} || '}}')"


def _text(sql: str) -> str:
    return f"""('"' || {sql} || '"')"""


_VERSIONS = {
    "candidateModelVersion": _text(f"'{CANDIDATE_MODEL}'"), "generationModelVersion": _text(f"'{GENERATION_MODEL}'"), "verifierSchemaVersion": _text("'targeted-verifier-schema-v4'"), "verifierPolicyVersion": _text("'targeted-verifier-policy-v8-2026-09'"),
    "providerContractVersion": _text("provider_contract"), "normalizerVersion": _text("'targeted-verifier-normalizer-v5-2026-09'"),
}
_PUBLICATION = "reconciliation-generation-publication-v1"
_SOURCE = canonical_object(manifestRootContentHash=_text("root_hash"), candidateArtifactHash=_text("candidate_hash"), barrierArtifactHash=_text("barrier_hash"), sourceProvenance="source_provenance")
#: Ids of a publication, each the hash of the material below it (scope and source_provenance are canonical texts).
COMMITMENT = "sha2(" + canonical_object(
    schema=_text("'reconciliation-generation-commitment-v1'"), scope="scope", sweepId=_text("sweep_id"), generationRootHash=_text("root_hash"), candidateArtifactHash=_text("candidate_hash"), barrierArtifactHash=_text("barrier_hash"), **_VERSIONS
) + ", 256)"
SOURCE_EVIDENCE = f"sha2({_SOURCE}, 256)"
PUBLICATION = "sha2(" + canonical_object(
    schema=_text(f"'{_PUBLICATION}'"), schemaVersion=_text(f"'{_PUBLICATION}'"), generationCommitmentId=_text("commitment_id"), publicationSequence="CAST(sequence AS STRING)", publicationState=_text("publication_state"), sourceEvidenceHash=_text("source_evidence_hash"), sourceArtifactIdentity=_SOURCE
) + ", 256)"


def published(valid: DataFrame) -> DataFrame:
    """Adds commitment_id, source_evidence_hash and publication_id to rows with the hashes, scope, sequence and state of a publication."""
    return valid.withColumn("commitment_id", F.expr(COMMITMENT)).withColumn("source_evidence_hash", F.expr(SOURCE_EVIDENCE)).withColumn("publication_id", F.expr(PUBLICATION))


#: Stored publications whose columns contradict the ids that follow from their payload.
PUBLICATION_REASONS: R.Rules = (
    ("GENERATION_COMMITMENT_MISMATCH", "stored_commitment_id <> commitment_id"), ("SOURCE_EVIDENCE_MISMATCH", "stored_source_evidence_hash <> source_evidence_hash"),
    ("GENERATION_PUBLICATION_ID_MISMATCH", "stored_publication_id <> publication_id"), ("GENERATION_PUBLICATION_STATE_UNKNOWN", "publication_state NOT IN ('ACCEPTED', 'REJECTED', 'SUPERSEDED')"), ("GENERATION_PUBLICATION_SEQUENCE_INVALID", "sequence < 0"),
)


def decoded_publications(rows: DataFrame) -> DataFrame:
    """Stored publications with the ids that follow from their payload, and reasons where the stored_* ids or columns contradict it."""
    return published(rows).withColumn("reasons", R.reasons(PUBLICATION_REASONS))


#: The journal's evidence, one directory an asset, as SQL texts over (token_id, ms, t, candidates_text, advanced_text); each may use those before it.
_STEPS = {
    "h": "md5('sweep:' || token_id)", "sweep_id": "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-8' || substr(h, 18, 3) || '-' || substr(h, 21, 12)",
    "recorded": "'2024-01-20T00:00:00.' || lpad(CAST(t % 1000 AS VARCHAR(9)), 3, '0') || 'Z'", "source_provenance": canonical_object(journal=_text("sha2(token_id, 256)")),
    "candidate_payload": canonical_object(authorityGranted="'false'", modelVersion=_text(f"'{CANDIDATE_MODEL}'"), orders="'[' || candidates_text || ']'", sweepId=_text("sweep_id")),
    "candidate": canonical_object(
        artifactId=_text(f"'{CANDIDATE}'"), artifactSchemaVersion=_text(f"'{CANDIDATE_ENVELOPE}'"), artifactType=_text(f"'{CANDIDATE}'"), authorityGranted="'false'", candidateBundleHash=_text("sha2(candidate_payload, 256)"),
        candidateModelVersion=_text(f"'{CANDIDATE_MODEL}'"), payload="candidate_payload", sourceProvenance="source_provenance", sweepId=_text("sweep_id"),
    ),
    "barrier_payload": canonical_object(
        candidateAdvancement="'[' || advanced_text || ']'", deactivationAuthorityGranted="'false'", finalFence=canonical_object(outcome=_text("'FENCE_ELIGIBLE'")), state=_text("'VERIFIED'"), sweepId=_text("sweep_id")
    ),
    "barrier": canonical_object(
        artifactId=_text(f"'{BARRIER}'"), artifactSchemaVersion=_text(f"'{BARRIER_ENVELOPE}'"), artifactType=_text(f"'{BARRIER}'"), candidateArtifactHash=_text("sha2(candidate, 256)"), deactivationAuthorityGranted="'false'", fenceOutcome=_text("'FENCE_ELIGIBLE'"),
        generationModelVersion=_text(f"'{GENERATION_MODEL}'"), generationResultHash=_text("sha2(barrier_payload, 256)"), payload="barrier_payload", semanticStatement=_text(f"'{STATEMENT}'"), sourceProvenance="source_provenance",
        state=_text("CASE WHEN t % 29 = 5 THEN 'ABORTED' ELSE 'VERIFIED' END"), sweepId=_text("sweep_id"),
    ),
    **{
        f"step{n}": canonical_object(fromState=_text(a), recordedAt=_text("recorded"), sequence=f"'{n}'", sweepId=_text("sweep_id"), toState=_text(b))
        for n, (a, b) in enumerate((("'OPEN'", "'TRANSPORT_COMPLETE'"), ("'TRANSPORT_COMPLETE'", "'CATCHING_UP'"), ("CASE WHEN t % 23 = 4 THEN 'OPEN' ELSE 'CATCHING_UP' END", "'VERIFIED'")), 1)
    },
    "transitions": "step1 || chr(10) || step2 || chr(10) || step3 || chr(10)",
    **{
        f"ref_{name}": canonical_object(
            artifactId=_text(f"'{id_}'"), artifactType=_text(f"'{kind}'"), byteLength=f"CAST(length({name}) AS VARCHAR(9))", contentHash=_text(f"sha2({name}, 256)"), relativePath=_text(f"'{path}'"), schemaVersion=_text(f"'{version}'"), sweepId=_text("sweep_id")
        )
        for name, kind, id_, path, version in (("barrier", BARRIER, BARRIER, f"{BARRIER}.json", BARRIER_ENVELOPE), ("candidate", CANDIDATE, CANDIDATE, f"{CANDIDATE}.json", CANDIDATE_ENVELOPE), ("transitions", "transitions", "history", TRANSITIONS, EVIDENCE_VERSION))
    },
    "scope": canonical_object(chain=_text("'chain'"), collection=_text("'collection-' || token_id"), contract=_text("'0x' || substr(sha2(token_id, 256), 1, 40)"), endpoint=_text("'https://provider.example'")),
    # the root's hash is left out of what it hashes, and stands between policyHash and scope
    "head": "'{\"artifacts\":[' || ref_barrier || ',' || ref_candidate || ',' || ref_transitions || '],' || " + f"""'"canonicalizationVersion":"{CANONICAL_VERSION}","evidenceSchemaVersion":"{EVIDENCE_VERSION}","modelVersion":"' || CASE WHEN t % 59 = 12 THEN ' ' ELSE '{GENERATION_MODEL}' END || '","policyHash":"' || sha2('policy', 256) || '"'""",
    "tail": f"""',"scope":' || scope || ',"semanticStatement":"{STATEMENT}","snapshotStartedAt":"' || recorded || '","sourceProvenance":' || source_provenance || ',"sweepId":"' || sweep_id || '","writerProvenance":' || source_provenance || '}}'""",
    "root_hash": "sha2(head || tail, 256)", "manifest": """head || ',"rootContentHash":"' || root_hash || '"' || tail""",
}
#: What happened to the files since: path, column, and which directories have it, as it was or otherwise.
_FILES = (
    (ROOT, "CASE WHEN t % 37 = 7 THEN replace(manifest, 'policyHash\":\"', 'policyHash\":\"0') WHEN t % 61 = 13 THEN substr(manifest, 1, 200) ELSE manifest END", "t % 41 <> 8"), (f"{CANDIDATE}.json", "CASE WHEN t % 19 = 3 THEN candidate || ' ' ELSE candidate END", "true"),
    (f"{BARRIER}.json", "barrier", "t % 43 <> 9"), (TRANSITIONS, "transitions", "true"), ("notes.tmp", "token_id", "t % 47 = 10"),
)
_CANDIDATE_ITEM = """'{"classification":"' || class || '","orderHash":"' || order_hash || '"}'"""
_ADVANCED_ITEM = """'{"orderHash":"' || order_hash || '","sourceClassification":"' || CASE WHEN t % 31 = 6 THEN 'BLOCKED' ELSE class END || '"}'"""
_CLASS = "CASE WHEN n % 3 = 0 THEN 'PRESENT' ELSE 'ABSENT_CANDIDATE' END"
#: Stored publications of valid directories, of which some were altered.
_STORED = {
    "provider_contract": "'provider-order-v3'", "sequence": "t", "publication_state": "CASE WHEN t % 3 = 1 THEN 'SUPERSEDED' ELSE 'ACCEPTED' END",
    "stored_commitment_id": "CASE WHEN t % 5 = 1 THEN sha2('other', 256) ELSE commitment_id END", "stored_source_evidence_hash": "CASE WHEN t % 7 = 2 THEN sha2('other', 256) ELSE source_evidence_hash END", "stored_publication_id": "CASE WHEN t % 11 = 3 THEN sha2('other', 256) ELSE publication_id END",
}


def _duck(sql: str) -> str:
    return sql.replace("sha2(", "sha256(").replace(", 256)", ")").replace("VARCHAR(9)", "VARCHAR").replace("AS STRING", "AS VARCHAR")


def _chain(first: str, steps: dict[str, str]) -> str:
    """Nested selects, each with one more column."""
    for name, sql in steps.items():
        first = f"SELECT *, {_duck(sql)} AS {name} FROM ({first})"
    return first


STORE_SQL = JOURNAL_SQL + f""", orders_ AS (SELECT token_id, order_hash, CAST(token_id AS BIGINT) AS t, {_CLASS} AS class FROM (SELECT token_id, order_hash, count(*) AS n FROM j WHERE order_hash IS NOT NULL GROUP BY ALL)),
listed AS (SELECT token_id, t, string_agg({_CANDIDATE_ITEM}, ',' ORDER BY order_hash) AS candidates_text, string_agg({_ADVANCED_ITEM}, ',' ORDER BY order_hash) AS advanced_text FROM orders_ GROUP BY token_id, t),
made AS MATERIALIZED ({_chain('SELECT * FROM listed', _STEPS)}),
files AS MATERIALIZED ({' UNION ALL '.join(f"SELECT token_id AS directory, sweep_id, '{path}' AS path, {_duck(content)} AS content FROM made WHERE {where}" for path, content, where in _FILES)}),
parsed AS MATERIALIZED (SELECT directory, sweep_id, content, CASE WHEN json_valid(content) THEN CAST(content AS JSON) END AS m FROM files WHERE path = '{ROOT}'),
refs AS MATERIALIZED (SELECT directory, (a->>'relativePath') AS path, (a->>'contentHash') AS declared, CAST(a->>'byteLength' AS BIGINT) AS bytes FROM (SELECT directory, unnest(CAST(m->'artifacts' AS JSON[])) AS a FROM parsed WHERE m IS NOT NULL)),
met AS (SELECT coalesce(f.directory, r.directory) AS directory, f.path AS path, r.path AS listed, sha256(f.content) AS hash, strlen(f.content) AS length, declared, bytes FROM (SELECT * FROM files WHERE path <> '{ROOT}') f FULL JOIN refs r ON r.directory = f.directory AND r.path = f.path),
faults AS (SELECT directory, bool_or(path LIKE '%.tmp') AS partial, bool_or(listed IS NULL) AS unregistered, bool_or(path IS NULL) AS lost, coalesce(bool_or(hash <> declared OR length <> bytes), false) AS differing FROM met GROUP BY directory),
steps AS (SELECT directory, sweep_id, place, CAST(line AS JSON) AS s FROM (SELECT directory, sweep_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM (SELECT *, list_filter(string_split(content, chr(10)), lambda x: x <> '') AS lines FROM files WHERE path = '{TRANSITIONS}'))),
chained AS (SELECT *, coalesce(lag(s->>'toState') OVER (PARTITION BY directory ORDER BY place), 'OPEN') AS before FROM steps),
history AS (SELECT directory, bool_and(s->>'sweepId' = sweep_id AND CAST(s->>'sequence' AS BIGINT) = place AND (s->>'fromState') = before AND ({' OR '.join(f"(before = '{a}' AND (s->>'toState') IN ({', '.join(repr(x) for x in b)}))" for a, b in EDGES.items())})) AS sound_history FROM chained GROUP BY directory),
known AS (SELECT DISTINCT directory, sweep_id FROM files),
status_ AS (SELECT k.directory, k.sweep_id, p.m, (p.m->>'rootContentHash') AS root, CASE WHEN p.directory IS NULL THEN 'ROOT_MANIFEST_MISSING'
  WHEN p.m IS NULL OR (p.m->>'sweepId') <> k.sweep_id THEN 'INVALID_ROOT_MANIFEST' WHEN sha256(replace(p.content, ',"rootContentHash":"' || (p.m->>'rootContentHash') || '"', '')) <> (p.m->>'rootContentHash') THEN 'ROOT_HASH_MISMATCH'
  WHEN trim((p.m->>'modelVersion')) = '' THEN 'INVALID_GENERATION_IDENTITY'
  ELSE {R.reasons_text((*((n, c) for n, c in (("PARTIAL_ARTIFACT_PRESENT", "partial"), ("UNREGISTERED_ARTIFACT", "unregistered"), ("ARTIFACT_HASH_MISMATCH", "differing"), ("DECLARED_ARTIFACT_MISSING", "lost"))), ("INVALID_TRANSITION_HISTORY", "NOT coalesce(sound_history, true)")))} END AS reasons
  FROM known k LEFT JOIN parsed p USING (directory) LEFT JOIN faults USING (directory) LEFT JOIN history USING (directory)),
c AS (SELECT directory, CAST(content AS JSON) AS c, sha256(content) AS c_file FROM files WHERE path = '{CANDIDATE}.json'),
b AS (SELECT directory, CAST(content AS JSON) AS b, sha256(content) AS b_file FROM files WHERE path = '{BARRIER}.json'),
envelopes AS (SELECT s.*, c_file, b_file, c IS NULL OR b IS NULL AS absent, CAST(s.directory AS BIGINT) % 53 = 11 AS strange,
  (SELECT list_sort(list_transform(CAST(c->'payload'->'orders' AS JSON[]), lambda o: (o->>'orderHash') || ' ' || (o->>'classification')))) = list_sort(list_transform(CAST(b->'payload'->'candidateAdvancement' AS JSON[]), lambda o: (o->>'orderHash') || ' ' || (o->>'sourceClassification'))) AS handed,
  (b->>'state') = (b->'payload'->>'state') AND (b->>'candidateArtifactHash') = c_file AND (b->>'generationResultHash') = sha256(CAST(b->'payload' AS VARCHAR)) AS barrier_fits, (c->>'candidateBundleHash') = sha256(CAST(c->'payload' AS VARCHAR)) AS candidate_fits
  FROM status_ s LEFT JOIN c USING (directory) LEFT JOIN b USING (directory)),
found AS MATERIALIZED (SELECT directory, sweep_id, root, c_file, b_file, CASE WHEN reasons <> '' THEN reasons WHEN strange THEN 'INTEGRATION_PROVENANCE_MISMATCH' WHEN absent THEN 'INTEGRATION_ARTIFACT_MISSING'
  ELSE {R.reasons_text((("CANDIDATE_ENVELOPE_MISMATCH", "NOT candidate_fits"), ("BARRIER_ENVELOPE_MISMATCH", "NOT barrier_fits"), ("CANDIDATE_GENERATION_HANDOFF_MISMATCH", "NOT handed")))} END AS why,
  CASE WHEN reasons = 'ROOT_MANIFEST_MISSING' THEN 'INCOMPLETE' WHEN reasons <> '' THEN 'CORRUPT' WHEN strange THEN 'MISMATCHED' WHEN absent THEN 'INCOMPLETE' END AS early FROM envelopes),
told AS (SELECT directory, sweep_id, coalesce(early, CASE WHEN why <> '' THEN 'MISMATCHED' ELSE 'VALID' END) AS status, why AS reasons, root, c_file, b_file FROM found)"""


def evidence_files(rows: DataFrame) -> DataFrame:
    """(directory, sweep_id, path, content, scope, source_provenance, t) of the journal's evidence, after what happened to it."""
    orders = rows.where("order_hash IS NOT NULL").groupBy("token_id", "order_hash").agg(F.count(F.lit(1)).alias("n")).withColumns({"t": F.col("token_id").cast("bigint"), "class": F.expr(_CLASS)})
    items = F.array_sort(F.collect_list(F.struct("order_hash", F.expr(_CANDIDATE_ITEM).alias("c"), F.expr(_ADVANCED_ITEM).alias("a"))))
    made = orders.groupBy("token_id", "t").agg(items.alias("x")).select("token_id", "t", F.array_join("x.c", ",").alias("candidates_text"), F.array_join("x.a", ",").alias("advanced_text"))
    for name, sql in _STEPS.items():
        made = made.withColumn(name, F.expr(sql))
    listed = F.explode(F.array(*(F.struct(F.lit(path).alias("path"), F.expr(content).alias("content"), F.expr(where).alias("there")) for path, content, where in _FILES)))
    return made.select(F.col("token_id").alias("directory"), "sweep_id", "t", "scope", "source_provenance", listed.alias("f")).where("f.there").select("directory", "sweep_id", "t", "scope", "source_provenance", "f.path", "f.content")


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    files = staged(evidence_files(journal(spark, sf_dir)))
    provenance = F.when(F.col("t") % 53 == 11, F.create_map(F.lit("journal"), F.lit("other"))).otherwise(F.create_map(F.lit("journal"), F.sha2("directory", 256)))
    expected = files.select("directory", "t", F.col("sweep_id").alias("expected_sweep"), "scope", "source_provenance").distinct().withColumn("expected_provenance", provenance)
    return reconstructed(files, expected.select("directory", "expected_sweep", "expected_provenance")), expected


@query("evidence_directories", STORE_SQL + " SELECT directory, status, reasons FROM told")
def evidence_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each asset's evidence read back: valid, or what is wrong with its manifest, files, history, envelopes or provenance."""
    return _judged(spark, sf_dir)[0].select("directory", "status", "reasons")


_PAYLOAD = _chain("SELECT t.directory, t.sweep_id, root AS root_hash, c_file AS candidate_hash, b_file AS barrier_hash, scope, source_provenance, m.t FROM told t JOIN made m ON m.token_id = t.directory WHERE status = 'VALID'", {k: v for k, v in _STORED.items() if not k.startswith("stored")})


@query("publication_ids", STORE_SQL + ", stored AS (" + _chain(_PAYLOAD, {"commitment_id": COMMITMENT, "source_evidence_hash": SOURCE_EVIDENCE, "publication_id": PUBLICATION, **{k: v for k, v in _STORED.items() if k.startswith("stored")}}) + f""")
SELECT directory, commitment_id, source_evidence_hash, publication_id, {R.reasons_text(PUBLICATION_REASONS)} AS reasons FROM stored""")
def publication_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids under which valid evidence is published, and stored publications that contradict them."""
    valid, expected = _judged(spark, sf_dir)
    rows = valid.where("status = 'VALID'").join(expected.select("directory", "t", F.col("expected_sweep").alias("sweep_id"), "scope", "source_provenance"), "directory")
    for name, sql in _STORED.items():
        if not name.startswith("stored"):
            rows = rows.withColumn(name, F.expr(sql))
    stored = published(rows)
    stored = stored.withColumns({k: F.expr(v) for k, v in _STORED.items() if k.startswith("stored")})
    return decoded_publications(stored).select("directory", "commitment_id", "source_evidence_hash", "publication_id", "reasons")
