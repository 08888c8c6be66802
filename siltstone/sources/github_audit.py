"""GitHub audit log (JSON) to seven event classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import codes
from siltstone.functions import normalize as n
from siltstone.plans.spec import Field, Flow, GoldSpec, Ingest, SilverSpec, fields

PARSED = "github_audit_logs_silver"

# Column -> path of a text in the record.
TEXT_PATHS = {
    "event_id": "id",
    "actor": "actor",
    "user": "user",
    "organization": "org",
    "repository": "repo",
    "actor_country_code": "actor_location.country_code",
    "actor_country": "actor_location.country",
    "actor_region": "actor_location.region",
    "actor_city": "actor_location.city",
    "actor_ip": "actor_location.ip",
    "email": "data.email",
    "ref": "data.ref",
    "head": "data.head",
    "base": "data.base",
    "target_login": "data.target_login",
    "permission": "data.permission",
    "team": "data.team",
    "visibility": "data.visibility",
}
NUMBER_PATHS = {"created_at": "bigint", "data.hook_id": "int"}
# Parsed columns kept as leftovers.
LEFTOVERS = (
    "event_id", "action", "created_at_ms", "actor", "user", "organization", "repository", "actor_country_code",
    "actor_country", "actor_region", "actor_city", "actor_ip", "email", "ref", "head", "base", "target_login",
    "permission", "team", "visibility", "hook_id",
)

# Actions of each class.
ACTIONS = {
    "account_change": r"org\.(add_member|remove_member|update_member)",
    "authentication": r"user\.(login|logout)|oauth_authorization\.(create|destroy)",
    "authorize_session": r"repo\.(add_member|remove_member|update_member)|protected_branch\.(create|destroy)",
    "user_access": r"org\.(update_member|add_billing_manager)",
    "group_management": r"team\.(add_member|remove_member|create|destroy)",
    "entity_management": r"repo\.(create|destroy|rename|archived|access)|org\.rename",
    "api_activity": r"git\.(clone|fetch|push)|pull_request\.|deploy\.|workflow\.run|release\.",
}
ACTIVITY_NAMES = {
    "account_change": {1: "Create", 3: "Update", 4: "Delete"},
    "authentication": {1: "Logon", 2: "Logoff"},
    "authorize_session": {5: "Add", 6: "Remove"},
    "user_access": {3: "Update", 5: "Add", 6: "Remove"},
    "group_management": {1: "Create", 4: "Delete", 5: "Add", 6: "Remove"},
    "entity_management": {1: "Create", 3: "Update", 4: "Delete"},
    "api_activity": {1: "Create", 2: "Read", 3: "Update", 5: "Connect"},
}
# Activities that hang on the whole action.
ENTITY_ACTIVITIES = {
    "repo.create": 1,
    "repo.destroy": 4,
    "repo.rename": 3,
    "org.rename": 3,
    "repo.archived": 3,
    "repo.access": 3,
}
API_ACTIVITIES = {
    "git.push": 1,
    "pull_request.create": 1,
    "release.create": 1,
    "git.clone": 2,
    "git.fetch": 2,
    "pull_request.merge": 3,
    "pull_request.close": 3,
}


def flow(*inputs: str) -> Flow:
    created = n.number("$.created_at", "bigint")
    return Flow(
        name="github_audit_logs",
        provider="github",
        log_name="audit_logs",
        ingest=Ingest(
            name="github_audit_logs_bronze",
            inputs=inputs,
            format="json",
            single_variant=True,
            pre=(
                (
                    F.lit("github").alias("source"),
                    F.lit("audit_logs").alias("sourcetype"),
                    # Whole seconds, as the event classes of this source carry them.
                    F.timestamp_seconds(F.floor(created / 1000)).alias("time"),
                    "data",
                ),
            ),
        ),
        silver=(parsed(),),
        gold=(
            account_change(),
            authentication(),
            authorize_session(),
            user_access(),
            group_management(),
            entity_management(),
            api_activity(),
        ),
    )


def parsed() -> SilverSpec:
    return SilverSpec(
        name=PARSED,
        preserve=True,
        temporary=(
            Field("record", n.record({**dict.fromkeys(TEXT_PATHS.values(), "string"), **NUMBER_PATHS})),
        ),
        fields=fields(
            {
                # Mappings choose rows by it, so it is read alone: a filter on it needs no more.
                "action": n.text("$.action"),
                **{name: n.member(path) for name, path in TEXT_PATHS.items()},
                "created_at_ms": n.member("created_at"),
                "hook_id": n.member("data.hook_id"),
            }
        ),
    )


# The parsed column `action` is the vendor's word; the output `action` is Allowed/Denied.
def _action() -> Column:
    return F.col("action")


def _says(*words: str) -> Column:
    """Whether the vendor's action holds one of the words."""
    return _action().rlike("|".join(words))


def _ends(*words: str) -> Column:
    return _action().rlike(f"({'|'.join(words)})$")


def _severity(*rules: tuple[Column, int]) -> dict[str, Column]:
    return {
        "severity_id": n.first_match(rules, 1) if rules else F.lit(1),
        "severity": n.severity_name(F.col("severity_id")),
    }


def _result(failed: Column | None = None) -> dict[str, Column]:
    result = F.lit(1) if failed is None else n.first_match([(failed, 2)], 1)
    return {
        "status_id": result,
        "status": n.status_name(F.col("status_id")),
        "action_id": result,
        "action": n.action_name(F.col("action_id")),
    }


def _mapping(event_class: str, activity_id: Column, members: dict[str, Column]) -> GoldSpec:
    """Fields shared by the seven classes, then those of one."""
    activity_name = n.lookup(F.col("activity_id"), ACTIVITY_NAMES[event_class], "Other")
    return GoldSpec(
        name=event_class,
        input=PARSED,
        filter=_action().rlike(ACTIONS[event_class]),
        fields=fields(
            {
                "time": F.col("time"),
                **n.class_columns(event_class),
                "activity_id": activity_id,
                "activity_name": activity_name,
                "type_uid": n.type_uid(F.col("class_uid"), F.col("activity_id")),
                "type_name": n.type_name(codes.CLASSES[event_class][1], F.col("activity_name")),
                "timezone_offset": n.null_of("int"),
                "raw_data": n.raw_record(F.col("data")),
                **members,
                **n.user("actor.user", F.col("actor"), F.col("actor"), type=F.lit("User")),
                **n.metadata(
                    "GitHub", "GitHub Inc.", "github", "audit_logs", "JSON",
                    uid=F.col("event_id"),
                    event_code=_action(),
                    logged_time=F.col("processed_time"),
                    original_time=F.col("created_at_ms").cast("string"),
                ),
            }
        ),
    )


def _with_activity(members: dict[str, Column]) -> dict[str, Column]:
    """Some classes carry the activity name twice."""
    return {"activity": F.col("activity_name"), **members}


def _origin(*, source: bool = True) -> Column:
    items = [("organization", F.col("organization"))]
    return n.enrichments([*items, ("source", F.lit("github"))] if source else items, keep_null=True)


def _leftovers(names: list[str] = LEFTOVERS, *, raw: bool = False) -> Column:
    members = {name: F.col(name) for name in names}
    return n.unmapped({"raw_data": F.to_json("data"), **members} if raw else members)


def _person(uid: Column) -> dict[str, Column]:
    return n.user("user", uid, uid, type=F.lit("User"))


def _seen(*items: tuple[str, str, str]) -> Column:
    actor = ("actor", "User Name", F.col("actor"))
    return n.observables([actor, *((name, kind, F.col(column)) for name, kind, column in items)])


def account_change() -> GoldSpec:
    member = F.coalesce("target_login", "user")
    action = _action()
    did = n.first_match(
        [
            (action.endswith("add_member"), F.lit("added to")),
            (action.endswith("remove_member"), F.lit("removed from")),
            (action.endswith("update_member"), F.lit("updated in")),
        ],
        action,
    )
    place = n.first_match(
        [
            (action.startswith("org."), F.lit("organization")),
            (action.startswith("team."), n.sentence("team ", (F.col("team"), "unknown"))),
            (action.startswith("repo."), n.sentence("repository ", (F.col("repository"), "unknown"))),
        ],
        F.lit("entity"),
    )
    return _mapping(
        "account_change",
        n.first_match([(_ends("created"), 1), (_ends("updated", "renamed"), 3), (_ends("deleted"), 4)], 99),
        _with_activity(
            {
                **_severity((_says("delete", "suspend"), 4), (_says("create", "update"), 2)),
                **_result(failed=_says("failed")),
                "message": n.sentence(
                    "GitHub member ", did, " ", place, ": ", F.coalesce("target_login", "user", "actor")
                ),
                **_person(member),
                "observables": n.observables(
                    [("actor", "User Name", F.col("actor")), ("target_user", "User Name", member)]
                ),
                "enrichments": _origin(),
                "unmapped": _leftovers(raw=True),
            }
        ),
    )


def authentication() -> GoldSpec:
    oauth = _says("oauth")
    return _mapping(
        "authentication",
        n.first_match(
            [
                (_ends("login") | (_action() == "oauth_authorization.create"), 1),
                (_ends("logout") | (_action() == "oauth_authorization.destroy"), 2),
            ],
            99,
        ),
        _with_activity(
            {
                **_severity((_says("failed"), 4)),
                **_result(failed=_says("failed")),
                "auth_protocol": n.first_match([(oauth, "OAuth")], "Password"),
                "auth_protocol_id": n.first_match([(oauth, 2)], 1),
                "src_endpoint.ip": F.col("actor_ip"),
                "src_endpoint.location.city": F.col("actor_city"),
                "src_endpoint.location.country": F.col("actor_country"),
                "dst_endpoint.hostname": F.lit("github.com"),
                "dst_endpoint.name": F.lit("GitHub"),
                "observables": _seen(("src_ip", "IP Address", "actor_ip")),
                "enrichments": _origin(),
                "unmapped": _leftovers(raw=True),
            }
        ),
    )


def authorize_session() -> GoldSpec:
    place = F.coalesce("repository", "organization")
    return _mapping(
        "authorize_session",
        n.first_match([(_says("add"), 5), (_says("remove"), 6)], 99),
        {
            **_severity((_says("remove"), 3), (_says("add"), 2)),
            **_result(),
            "resource.uid": place,
            "resource.name": place,
            "resource.type": F.when(F.col("repository").isNotNull(), "Repository").otherwise("Organization"),
            "resource.owner.name": F.col("organization"),
            "resource.data": F.to_json(
                F.create_map(F.lit("ref"), F.col("ref"), F.lit("visibility"), F.col("visibility"))
            ).cast("variant"),
            "privileges": F.when(F.col("permission").isNotNull(), F.array("permission")),
            **_person(F.col("target_login")),
            "observables": _seen(("repository", "Resource Name", "repository")),
            "enrichments": _origin(),
            "unmapped": _leftovers(raw=True),
        },
    )


def user_access() -> GoldSpec:
    return _mapping(
        "user_access",
        n.first_match([(_says("add"), 5), (_says("remove"), 6), (_says("update"), 3)], 99),
        _with_activity(
            {
                **_severity((_says("remove"), 3), (_says("add"), 2)),
                **_result(),
                **_person(F.coalesce("target_login", "user")),
                "resource.uid": F.col("organization"),
                "resource.name": F.col("organization"),
                "privileges": F.array(F.coalesce("permission", F.lit("member"))),
                "observables": n.observables(
                    [
                        ("actor", "User Name", F.col("actor")),
                        ("target_user", "User Name", F.coalesce("target_login", "user")),
                    ]
                ),
                "enrichments": _origin(),
                "unmapped": _leftovers(raw=True),
            }
        ),
    )


def group_management() -> GoldSpec:
    return _mapping(
        "group_management",
        n.first_match(
            [(_ends("create"), 1), (_ends("destroy"), 4), (_ends("add_member"), 5), (_ends("remove_member"), 6)], 99
        ),
        _with_activity(
            {
                **_severity((_says("destroy"), 3), (_says("create"), 2)),
                **_result(),
                "group.uid": F.col("team"),
                "group.name": F.col("team"),
                "group.type": F.lit("Team"),
                **_person(F.col("target_login")),
                "observables": _seen(("team", "Group Name", "team")),
                "enrichments": _origin(),
                "unmapped": _leftovers(),
            }
        ),
    )


def entity_management() -> GoldSpec:
    return _mapping(
        "entity_management",
        n.lookup(_action(), ENTITY_ACTIVITIES, 99),
        {
            **_severity((_says("destroy"), 3), (_says("create"), 2)),
            **_result(),
            "entity.uid": F.col("repository"),
            "entity.name": F.get(F.split("repository", "/"), F.lit(1)),
            "entity.type": F.lit("Repository"),
            "src_endpoint.ip": F.col("actor_ip"),
            "src_endpoint.location.country": F.col("actor_country"),
            "src_endpoint.location.city": F.col("actor_city"),
            "cloud.provider": F.lit("GitHub"),
            "cloud.account.uid": F.col("organization"),
            "observables": _seen(("entity.uid", "Resource UID", "repository")),
            "enrichments": _origin(source=False),
            "unmapped": _leftovers(["event_id", "action", "actor", "organization", "repository", "visibility"]),
        },
    )


def api_activity() -> GoldSpec:
    repository = F.col("repository")
    resource = F.struct(
        repository.alias("name"),
        repository.alias("uid"),
        n.null_of("string").alias("hostname"),
        n.null_of("string").alias("ip"),
    )
    return _mapping(
        "api_activity",
        F.coalesce(n.lookup(_action(), API_ACTIVITIES), n.first_match([(_action().startswith("deploy."), 5)], 99)),
        {
            **_severity(),
            **_result(),
            "api.operation": _action(),
            "src_endpoint.ip": F.col("actor_ip"),
            "resources": F.when(repository.isNotNull(), F.array(resource)),
            "cloud.provider": F.lit("GitHub"),
            "cloud.account.uid": F.col("organization"),
            "observables": n.observables(
                [
                    ("actor.user.name", "User Name", F.col("actor")),
                    ("resources.uid", "Resource UID", repository),
                ]
            ),
            "enrichments": _origin(source=False),
            "unmapped": _leftovers(["event_id", "action", "actor", "organization", "repository", "ref", "head", "base"]),
        },
    )
