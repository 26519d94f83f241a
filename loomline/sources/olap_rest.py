"""OLAP server metadata over REST: a client with retries, and a Python data source with one partition for each scan unit.

    spark.dataSource.register(OlapSource)
    spark.read.format("olap").options(url=..., user=..., password_env=..., entity="members").load()
"""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomline.functions.scalars import consolidation_symbol, iso_timestamp, storage


class OlapError(Exception):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def http(method: str, url: str, headers: dict[str, str], body: bytes | None, timeout: float) -> tuple[int, bytes]:
    """Status and body of one request; raises OSError (and its kin) where there is no answer."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers, method=method), timeout=timeout) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


@dataclass
class Client:
    """REST client. 404 is None, other errors raise; only timeouts and lost connections are tried again, waiting longer each time."""

    url: str
    user: str = ""
    password: str = ""
    timeout: float = 30
    attempts: int = 3
    delay: float = 1
    send: Callable = http

    def get(self, path: str, params: dict | None = None, method: str = "GET", data: dict | None = None):
        url = f"{self.url.rstrip('/')}/essbase/rest/v1{path}" + (f"?{urlencode(params)}" if params else "")
        token = base64.b64encode(f"{self.user}:{self.password}".encode()).decode()
        headers = {"Accept": "application/json", "Content-Type": "application/json", "Authorization": f"Basic {token}"}
        for n in range(self.attempts):
            try:
                status, body = self.send(method, url, headers, json.dumps(data).encode() if data is not None else None, self.timeout)
                break
            except OSError as e:
                if n + 1 == self.attempts:
                    raise OlapError(f"no answer from {url}: {e}") from e
                time.sleep(self.delay * (n + 1))
        if status == 404:
            return None
        if status in (401, 403):
            raise OlapError("access denied", status)
        if status >= 400:
            raise OlapError(f"status {status} from {url}", status)
        return json.loads(body) if body else {}

    def _items(self, path: str, params: dict | None = None) -> list[dict]:
        return (self.get(path, params) or {}).get("items", [])

    @staticmethod
    def cube_path(app: str, cube: str, *rest: str) -> str:
        return "".join(["/applications/", quote(app, safe=""), "/databases/", quote(cube, safe=""), *[f"/{quote(r, safe='')}" for r in rest]])

    def about(self) -> dict:
        return self.get("/about") or {}

    def test(self) -> bool:
        try:
            return bool(self.about())
        except OlapError:
            return False

    def applications(self) -> list[dict]:
        return self._items("/applications")

    def application(self, app: str) -> dict | None:
        return self.get(f"/applications/{quote(app, safe='')}")

    def application_permissions(self, app: str) -> list[dict]:
        return self._items(f"/applications/{quote(app, safe='')}/permissions")

    def cubes(self, app: str) -> list[dict]:
        return self._items(f"/applications/{quote(app, safe='')}/databases")

    def cube(self, app: str, cube: str) -> dict | None:
        return self.get(self.cube_path(app, cube))

    def statistics(self, app: str, cube: str) -> dict:
        return self.get(self.cube_path(app, cube, "statistics")) or {}

    def dimensions(self, app: str, cube: str) -> list[dict]:
        return self._items(self.cube_path(app, cube, "dimensions"))

    def dimension(self, app: str, cube: str, dim: str) -> dict | None:
        return self.get(self.cube_path(app, cube, "dimensions", dim))

    def members_page(self, app: str, cube: str, dim: str, offset: int = 0, limit: int = 1000, parent: str | None = None, depth: int = -1) -> dict:
        params = {"offset": offset, "limit": limit, **({"parent": parent} if parent else {}), **({"depth": depth} if depth >= 0 else {})}
        return self.get(self.cube_path(app, cube, "dimensions", dim, "members"), params) or {}

    def member(self, app: str, cube: str, name: str) -> dict | None:
        return self.get(self.cube_path(app, cube, "members", name))

    def members(self, app: str, cube: str, dim: str, page: int = 500) -> Iterator[dict]:
        """All members, page by page up to the first empty one (servers need not tell a total)."""
        offset = 0
        while True:
            items = self.members_page(app, cube, dim, offset, page).get("items", [])
            if not items:
                return
            yield from items
            offset += len(items)

    def scripts(self, app: str, cube: str) -> list[dict]:
        return self._items(self.cube_path(app, cube, "scripts"))

    def script(self, app: str, cube: str, name: str) -> dict | None:
        return self.get(self.cube_path(app, cube, "scripts", name))

    def script_content(self, app: str, cube: str, name: str) -> str | None:
        return (self.script(app, cube, name) or {}).get("content")

    def rules(self, app: str, cube: str, kind: str = "data") -> list[dict]:
        return self._items(self.cube_path(app, cube, "rules"), {"type": kind})

    def rule(self, app: str, cube: str, name: str, kind: str = "data") -> dict | None:
        return self.get(self.cube_path(app, cube, "rules", name), {"type": kind})

    def locks(self, app: str, cube: str) -> list[dict]:
        return self._items(self.cube_path(app, cube, "locks"))

    def jobs(self, **filters) -> list[dict]:
        return self._items("/jobs", {k: v for k, v in filters.items() if v is not None})

    def job(self, job_id: int) -> dict | None:
        return self.get(f"/jobs/{job_id}")

    def sessions(self) -> list[dict]:
        return self._items("/sessions")

    def mdx(self, app: str, cube: str, query: str) -> dict | None:
        """A query as it is; the server interprets it."""
        return self.get(self.cube_path(app, cube, "mdx"), method="POST", data={"query": query})

    def grid(self, app: str, cube: str) -> dict | None:
        return self.get(self.cube_path(app, cube, "grid"))

    def outline(self, app: str, cube: str) -> dict | None:
        return self.get(self.cube_path(app, cube, "outline"))


@dataclass
class Unit(InputPartition):
    app: str
    cube: str = ""
    dim: str = ""
    ord: int = 0


#: entity -> schema of its rows; `detail` is what the server said, as JSON.
ENTITIES = {
    "applications": "app string, detail string",
    "cubes": "app string, cube string, detail string, statistics string",
    "dimensions": "app string, cube string, dim string, dim_ord int, detail string",
    "members": "app string, cube string, dim string, dim_ord int, ordinal long, name string, detail string",
    "scripts": "app string, cube string, script string, content string, detail string, error string",
    "rules": "app string, cube string, rule_type string, rule string, detail string",
    "sessions": "detail string",
    "jobs": "detail string",
}


class OlapReader(DataSourceReader):
    def __init__(self, options: dict, client: Callable[[], Client]):
        self.options, self.client = options, client
        self.entity = options.get("entity", "members")

    def _names(self, key: str) -> list[str] | None:
        return [x.strip() for x in self.options[key].split(",")] if self.options.get(key) else None

    def partitions(self) -> list[Unit]:
        """One for each (application, cube, dimension) that the entity has; names not asked for are never fetched."""
        c, e = self.client(), self.entity
        if e in ("sessions", "jobs"):
            return [Unit("")]
        apps = self._names("applications") or [a["name"] for a in c.applications()]
        if e == "applications":
            return [Unit(a) for a in apps]
        wanted = self._names("cubes")
        cubes = [(a, x["name"]) for a in apps for x in c.cubes(a) if not wanted or x["name"] in wanted]
        if e != "members":
            return [Unit(a, x) for a, x in cubes]
        return [Unit(a, x, d["name"], i) for a, x in cubes for i, d in enumerate(c.dimensions(a, x))]

    def read(self, p: Unit | None) -> Iterator[tuple]:
        if p is None:  # no partition at all
            return
        c, e, say = self.client(), self.entity, json.dumps
        if e == "applications":
            yield p.app, say(c.application(p.app))
        elif e == "cubes":
            yield p.app, p.cube, say(c.cube(p.app, p.cube)), say(c.statistics(p.app, p.cube))
        elif e == "dimensions":
            for i, d in enumerate(c.dimensions(p.app, p.cube)):
                yield p.app, p.cube, d["name"], i, say(c.dimension(p.app, p.cube, d["name"]) or d)
        elif e == "members":
            most = int(self.options.get("maxMembers", "0"))
            for i, m in enumerate(c.members(p.app, p.cube, p.dim, int(self.options.get("pageSize", "500")))):
                if most and i >= most:
                    return
                yield p.app, p.cube, p.dim, p.ord, i, m.get("name"), say(m)
        elif e == "scripts":
            for s in c.scripts(p.app, p.cube):
                if s.get("name"):
                    try:
                        found, error = c.script(p.app, p.cube, s["name"]) or {}, None
                    except OlapError as e:  # one script must not end the read
                        found, error = {}, str(e)
                    yield p.app, p.cube, s["name"], found.get("content"), say(found), error
        elif e == "rules":
            for kind in ("data", "dimension"):
                for r in c.rules(p.app, p.cube, kind):
                    if r.get("name"):
                        yield p.app, p.cube, kind, r["name"], say(c.rule(p.app, p.cube, r["name"], kind) or {})
        elif e == "sessions":
            yield from ((say(x),) for x in c.sessions())
        elif e == "jobs":
            yield from ((say(x),) for x in c.jobs())


class OlapSource(DataSource):
    """options: url, user, password_env, entity, applications, cubes, pageSize, maxMembers, fixture (a module:function that makes the sender, for tests)."""

    @classmethod
    def name(cls) -> str:
        return "olap"

    def schema(self) -> str:
        return ENTITIES[self.options.get("entity", "members")]

    def reader(self, schema) -> OlapReader:
        o = dict(self.options)

        def client() -> Client:
            send = http
            if o.get("fixture"):
                import importlib

                module, function = o["fixture"].split(":")
                send = getattr(importlib.import_module(module), function)
            return Client(o.get("url", ""), o.get("user", ""), os.environ.get(o.get("password_env", ""), ""), send=send, delay=float(o.get("delay", "1")))

        return OlapReader(o, client)


def read_olap(spark: SparkSession, entity: str, **options: str) -> DataFrame:
    spark.dataSource.register(OlapSource)
    return spark.read.format("olap").options(entity=entity, **options).load()


MEMBER = "name string, parent string, aliases map<string,string>, levelNumber int, generationNumber int, consolidation string, dataStorage string, formula string, userDefinedAttributes array<string>, numberOfChildren int"


def member_rows(raw: DataFrame, formulas: bool = True, aliases: bool = True, attributes: bool = True, max_generation: int | None = None) -> DataFrame:
    """Members in the engine's form: app, cube, dim, dim_ord, ordinal, name, alias, parent, level, generation, consolidation, storage, formula, uda."""
    d = raw.withColumn("m", F.from_json("detail", MEMBER))
    keep = lambda on, c: c if on else F.lit(None)
    out = d.select(
        "app", "cube", "dim", "dim_ord", "ordinal", "name", keep(aliases, F.get(F.map_values("m.aliases"), F.lit(0))).cast("string").alias("alias"),
        F.nullif("m.parent", F.lit("")).alias("parent"), F.col("m.levelNumber").alias("level"), F.col("m.generationNumber").alias("generation"),
        consolidation_symbol(F.col("m.consolidation")).alias("consolidation"), storage(F.col("m.dataStorage")).alias("storage"),
        keep(formulas, F.col("m.formula")).cast("string").alias("formula"), F.coalesce(keep(attributes, F.col("m.userDefinedAttributes")), F.array()).cast("array<string>").alias("uda"),
    )
    return out if max_generation is None else out.where(F.coalesce("generation", F.lit(0)) <= max_generation)


STATISTICS = "numberOfBlocks long, blockDensity double, numberOfExistingBlocks long, lastRestructured string"


def cube_statistics(raw: DataFrame) -> DataFrame:
    s = raw.withColumn("s", F.from_json("statistics", STATISTICS))
    return s.select("app", "cube", F.col("s.numberOfBlocks").alias("number_of_blocks"), F.col("s.blockDensity").alias("block_density"), F.col("s.numberOfExistingBlocks").alias("existing_blocks"), iso_timestamp(F.col("s.lastRestructured")).alias("last_restructured"))
