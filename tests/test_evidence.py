import hashlib
import json
import random

import pytest

from tidemark.operators import evidence_graph as G
from tidemark.operators import evidence_store as S


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(nodes, edges):
    """Hashes by recursion; None in a cycle or above one."""
    children = {}
    for parent, child, declared in edges:
        children.setdefault(parent, []).append((child, declared))

    def visit(name, path):
        if name in path:
            return None
        lines, missing, altered = [], False, False
        for child, declared in children.get(name, []):
            if child not in nodes:
                lines.append((child, declared or ""))
                missing = True
                continue
            below = visit(child, path | {name})
            if below is None:
                return None
            lines.append((child, below[0]))
            missing, altered = missing or below[1], altered or below[2] or (declared is not None and declared != below[0])
        buckets = {}
        for child, value in sorted(lines):
            buckets.setdefault(sha(child)[: G.BUCKET], []).append(f"{child}:{value}")
        digest = sha("\n".join(sha("\n".join(x)) for _, x in sorted(buckets.items()))) if lines else None
        return sha("\n".join([nodes[name], *([digest] if digest else [])])), missing, altered

    return {name: found for name in nodes if (found := visit(name, frozenset())) is not None}


def test_rehash_equals_recursion(spark):
    rng = random.Random(1)
    names = [f"n{i}" for i in range(40)]
    nodes = {n: f"content of {n}" for n in names if rng.random() < 0.9}
    edges = [(names[i], names[j], rng.choice([None, "stale"])) for i in range(40) for j in range(i + 1, min(40, i + 6)) if rng.random() < 0.3]
    edges += [("n20", "n3", None)]  # a circle
    edges = list({(p, c): d for p, c, d in edges}.items())
    edges = [(p, c, d) for (p, c), d in edges]
    found = G.rehash(spark.createDataFrame(list(nodes.items()), "name string, content string"), spark.createDataFrame(edges, "parent string, child string, declared string"))
    assert {r["name"]: (r["found"], r["missing"], r["altered"]) for r in found.collect()} == brute(nodes, edges)


def shuffled(spark):
    """Bytes that all stages so far wrote for shuffles."""
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


@pytest.mark.parametrize("many", [2, 4096])
def test_contents_are_shuffled_once_whatever_the_levels(spark, monkeypatch, many):
    """A tall graph over long contents, joined by shuffle as large tables are; large artifacts are digested by bucket."""
    monkeypatch.setattr(G, "MANY", many, raising=False)
    rng = random.Random(4)
    nodes = {f"l{i}": rng.randbytes(1500).hex() for i in range(300)} | {f"h{i}": f"inner {i}" for i in range(6)}
    edges = [(f"h{i % 6}", f"l{i}", None) for i in range(300)] + [(f"h{i}", f"h{i - 1}", None) for i in range(1, 6)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    start = shuffled(spark)
    try:
        found = G.rehash(spark.createDataFrame(list(nodes.items()), "name string, content string"), spark.createDataFrame(edges, "parent string, child string, declared string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["name"]: (r["found"], r["missing"], r["altered"]) for r in found} == brute(nodes, edges)
    assert max(r["height"] for r in found) == 6 and shuffled(spark) - start < 2 * 300 * 3000


def test_edges_are_sealed_with_the_hashes_of_their_children(spark):
    """Also those of parents that are not there, or that wait for ever."""
    nodes = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("d", "z")], "name string, content string")
    edges = spark.createDataFrame([("a", "b", None), ("b", "c", None), ("d", "d", None), ("d", "b", "stale"), ("gone", "c", None), ("a", "gone", None)], "parent string, child string, declared string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(G.rehashed(nodes, edges).edges) == rows(G.sealed(edges.drop("declared"), G.rehash(nodes, edges)))


def test_every_status_of_a_root(spark):
    nodes = {"r": "root", "a": "a", "b": "b", "leaf": "x", "leaf2": "y"}
    edges = [("r", "a"), ("r", "b"), ("a", "leaf"), ("b", "leaf"), ("b", "leaf2")]
    cases = [
        (nodes, [], ("COMPLETE", "")),
        ({k: v for k, v in nodes.items() if k != "leaf"}, [], ("INCOMPLETE", "DECLARED_ARTIFACT_MISSING")),
        ({**nodes, "leaf2": "other"}, [], ("CORRUPT", "ARTIFACT_HASH_MISMATCH")),
        ({k: v + "!" for k, v in nodes.items() if k != "leaf"}, [], ("CORRUPT", "ARTIFACT_HASH_MISMATCH,DECLARED_ARTIFACT_MISSING")),
        ({k: v for k, v in nodes.items() if k != "r"}, [], ("INCOMPLETE", "ROOT_MANIFEST_MISSING")),
        (nodes, [("leaf", "r")], ("CORRUPT", "EVIDENCE_CYCLE")),
    ]
    name = lambda i, n: f"{i}/{n}"
    links = spark.createDataFrame([(name(i, p), name(i, c)) for i in range(len(cases)) for p, c in edges], "parent string, child string")
    written = G.rehash(spark.createDataFrame([(name(i, k), v) for i in range(len(cases)) for k, v in nodes.items()], "name string, content string"), links.selectExpr("*", "CAST(NULL AS STRING) AS declared"))
    more = spark.createDataFrame([(name(i, p), name(i, c), None) for i, (_, extra, _) in enumerate(cases) for p, c in extra], "parent string, child string, declared string")
    now = spark.createDataFrame([(name(i, k), v) for i, (changed, _, _) in enumerate(cases) for k, v in changed.items()], "name string, content string")
    roots = written.where("name LIKE '%/r'").selectExpr("name", "found AS declared")
    told = {r["name"]: (r["status"], r["reasons"]) for r in G.root_status(roots, now, G.sealed(links, written).unionAll(more)).collect()}
    assert told == {name(i, "r"): expected for i, (_, _, expected) in enumerate(cases)}


SWEEP = "0f0f0f0f-1111-4222-8333-444444444444"


def directory(**changes):
    """Files of a sound directory by path; ``changes`` replaces texts before they are declared."""
    dump = lambda v: json.dumps(v, sort_keys=True, separators=(",", ":"))
    provenance = {"journal": sha("source")}
    payload = {"orders": [{"orderHash": "0xa", "classification": "PRESENT"}], "sweepId": SWEEP}
    candidate = {"artifactType": S.CANDIDATE, "artifactId": S.CANDIDATE, "artifactSchemaVersion": S.CANDIDATE_ENVELOPE, "sweepId": SWEEP, "candidateModelVersion": S.CANDIDATE_MODEL, "sourceProvenance": provenance, "candidateBundleHash": sha(dump(payload)), "authorityGranted": False, "payload": payload, **changes.get("candidate", {})}
    result = {"state": "VERIFIED", "finalFence": {"outcome": "FENCE_ELIGIBLE"}, "candidateAdvancement": [{"orderHash": "0xa", "sourceClassification": "PRESENT"}]} | changes.get("result", {})
    barrier = {"artifactType": S.BARRIER, "artifactId": S.BARRIER, "artifactSchemaVersion": S.BARRIER_ENVELOPE, "sweepId": SWEEP, "generationModelVersion": S.GENERATION_MODEL, "sourceProvenance": provenance, "generationResultHash": sha(dump(result)), "candidateArtifactHash": sha(dump(candidate)), "state": "VERIFIED", "fenceOutcome": "FENCE_ELIGIBLE", "semanticStatement": S.STATEMENT, "deactivationAuthorityGranted": False, "payload": result} | changes.get("barrier", {})
    states = changes.get("states", ["OPEN", "TRANSPORT_COMPLETE", "CATCHING_UP", "VERIFIED"])
    history = "".join(dump({"sweepId": SWEEP, "sequence": i, "fromState": a, "toState": b, "recordedAt": "2024-01-01T00:00:00.000Z"}) + "\n" for i, (a, b) in enumerate(zip(states, states[1:]), 1))
    files = {f"{S.CANDIDATE}.json": dump(candidate), f"{S.BARRIER}.json": dump(barrier), S.TRANSITIONS: history}
    kinds = {f"{S.CANDIDATE}.json": (S.CANDIDATE, S.CANDIDATE), f"{S.BARRIER}.json": (S.BARRIER, S.BARRIER), S.TRANSITIONS: ("transitions", "history")}
    refs = [{"artifactType": kinds[p][0], "artifactId": kinds[p][1], "sweepId": SWEEP, "relativePath": p, "schemaVersion": "v1", "contentHash": sha(t), "byteLength": len(t.encode())} | changes.get("ref", {}) for p, t in files.items()]
    manifest = {"sweepId": SWEEP, "modelVersion": "m", "snapshotStartedAt": "2024-01-01T00:00:00.000Z", "policyHash": "p", "scope": {"chain": "c", "collection": "d", "contract": "0x" + "a" * 40, "endpoint": "https://e"}, "sourceProvenance": provenance, "evidenceSchemaVersion": S.EVIDENCE_VERSION, "canonicalizationVersion": S.CANONICAL_VERSION, "generationKey": sha("k"), "artifacts": refs, "writerProvenance": {}, "semanticStatement": S.STATEMENT, **changes.get("manifest", {})}
    return {**files, S.ROOT: json.dumps({**manifest, "rootContentHash": sha(dump(manifest))})}


def judged(spark, directories):
    """(status, reasons) of each case, given as (files, provenance)."""
    rows = [(str(i), SWEEP, p, t) for i, (files, _) in enumerate(directories) for p, t in files.items()]
    expected = [(str(i), SWEEP, provenance or {"journal": sha("source")}) for i, (_, provenance) in enumerate(directories)]
    files = spark.createDataFrame(rows, "directory string, sweep_id string, path string, content string")
    found = S.reconstructed(files, spark.createDataFrame(expected, "directory string, expected_sweep string, expected_provenance map<string,string>"))
    told = {r["directory"]: (r["status"], r["reasons"]) for r in found.collect()}
    return [told[str(i)] for i in range(len(directories))]


CASES = [
    ({}, ("VALID", "")),
    ({"manifest": {"semanticStatement": "other"}}, ("CORRUPT", "INVALID_ROOT_MANIFEST")),
    ({"manifest": {"policyHash": " "}}, ("CORRUPT", "INVALID_GENERATION_IDENTITY")),
    ({"manifest": {"scope": {"chain": "c", "collection": "d", "contract": "0x1", "endpoint": "https://e"}}}, ("CORRUPT", "INVALID_GENERATION_SCOPE")),
    ({"manifest": {"sourceProvenance": {"journal": "short"}}}, ("CORRUPT", "INVALID_PROVENANCE")),
    ({"ref": {"byteLength": -1}}, ("CORRUPT", "INVALID_ARTIFACT_REF")),
    ({"ref": {"artifactType": "same", "artifactId": "same"}}, ("CORRUPT", "DUPLICATE_ARTIFACT_IDENTITY")),
    ({"ref": {"relativePath": "../up"}}, ("CORRUPT", "INVALID_ARTIFACT_PATH")),
    ({"states": ["OPEN", "CATCHING_UP"]}, ("CORRUPT", "INVALID_TRANSITION_HISTORY")),
    ({"states": ["OPEN", "TRANSPORT_COMPLETE", "ABORTED", "VERIFIED"]}, ("CORRUPT", "INVALID_TRANSITION_HISTORY")),
    ({"candidate": {"candidateBundleHash": sha("other")}}, ("MISMATCHED", "CANDIDATE_ENVELOPE_MISMATCH")),
    ({"barrier": {"candidateArtifactHash": sha("other")}}, ("MISMATCHED", "BARRIER_ENVELOPE_MISMATCH")),
    ({"barrier": {"fenceOutcome": "FENCE_BLOCKED"}}, ("MISMATCHED", "BARRIER_ENVELOPE_MISMATCH")),
    ({"result": {"candidateAdvancement": []}}, ("MISMATCHED", "CANDIDATE_GENERATION_HANDOFF_MISMATCH")),
]


def test_directories(spark):
    sound = directory()
    without = lambda name: {p: t for p, t in sound.items() if p != name}
    changed = [
        (without(S.ROOT), None, ("INCOMPLETE", "ROOT_MANIFEST_MISSING")),
        (without(S.TRANSITIONS), None, ("CORRUPT", "DECLARED_ARTIFACT_MISSING,INVALID_TRANSITION_HISTORY")),
        ({**sound, "x.tmp": ""}, None, ("CORRUPT", "PARTIAL_ARTIFACT_PRESENT,UNREGISTERED_ARTIFACT")),
        ({**sound, f"{S.BARRIER}.json": "{}"}, None, ("CORRUPT", "ARTIFACT_HASH_MISMATCH")),
        ({**sound, S.ROOT: sound[S.ROOT].replace('"m"', '"n"')}, None, ("CORRUPT", "ROOT_HASH_MISMATCH")),
        ({**sound, S.ROOT: "{"}, None, ("CORRUPT", "INVALID_ROOT_MANIFEST")),
        (sound, {"journal": sha("elsewhere")}, ("MISMATCHED", "INTEGRATION_PROVENANCE_MISMATCH")),
    ]
    cases = [(directory(**changes), None, expected) for changes, expected in CASES] + changed
    assert judged(spark, [(files, provenance) for files, provenance, _ in cases]) == [expected for *_, expected in cases]


def test_directories_are_read_from_files(spark, tmp_path):
    place = tmp_path / "evidence" / SWEEP
    place.mkdir(parents=True)
    for path, text in directory().items():
        (place / path).write_text(text)
    found = S.directory_status(S.read_directories(spark, str(tmp_path / "evidence"))).select("directory", "status", "reasons").collect()
    assert [tuple(r) for r in found] == [(SWEEP, "COMPLETE", "")]
