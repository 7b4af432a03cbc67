"""Comment records out of captured JSON, as column expressions on VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.text import first_nonempty

# ---- fixed values -----------------------------------------------------------
MUTATIONS = "$.frameworkUpdates.entityBatchUpdate.mutations"
ENTITY = "$.payload.commentEntityPayload"
ACTIONS = "$.onResponseReceivedEndpoints"
RELOADED = "$.reloadContinuationItemsCommand.continuationItems"
APPENDED = "$.appendContinuationItemsAction.continuationItems"
THREAD_RENDERER = "$.commentThreadRenderer.comment.commentRenderer"
PLAIN_RENDERER = "$.commentRenderer"
EMBEDDED_DATA = (
    r'(?s)ytInitialData"?\s*[:=]\s*(\{.*?\})\s*;</script',
    r'(?s)window\[\s*"ytInitialData"\s*\]\s*=\s*(\{.*?\});',
)
# -----------------------------------------------------------------------------


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _list(v: Column, path: str) -> Column:
    return F.coalesce(_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _present(v: Column) -> Column:
    """Neither missing, nor null, nor {}."""
    return F.coalesce(~F.schema_of_variant(v).isin("VOID", "OBJECT<>"), F.lit(False))


def _entry(comment_id, author, text, likes, published) -> Column:
    return F.struct(
        comment_id.alias("comment_id"),
        author.alias("author"),
        F.coalesce(text, F.lit("")).alias("text"),
        likes.alias("like_count"),
        published.alias("published_at"),
    )


def modern_comments(v: Column) -> Column:
    """Entity mutations; the text is a string or an object with one."""

    def one(m):
        content = _get(m, f"{ENTITY}.properties.content", "variant")
        text = F.when(F.schema_of_variant(content) == "STRING", content.cast("string")).otherwise(
            _get(m, f"{ENTITY}.properties.content.content")
        )
        return _entry(
            _get(m, f"{ENTITY}.properties.commentId"),
            first_nonempty(_get(m, f"{ENTITY}.author.displayName"), _get(m, f"{ENTITY}.properties.authorButtonA11y")),
            text,
            _get(m, f"{ENTITY}.properties.likeCount"),
            _get(m, f"{ENTITY}.properties.publishedTime"),
        )

    filled = F.filter(_list(v, MUTATIONS), lambda m: _present(_get(m, f"{ENTITY}.properties", "variant")))
    return F.transform(filled, one)


def legacy_comments(v: Column) -> Column:
    """Renderers under two kinds of action and two paths; text runs joined."""

    def items(action):
        reloaded = _list(action, RELOADED)
        return F.when(F.size(reloaded) > 0, reloaded).otherwise(_list(action, APPENDED))

    def renderer(container):
        threaded = _get(container, THREAD_RENDERER, "variant")
        return F.when(_present(threaded), threaded).otherwise(_get(container, PLAIN_RENDERER, "variant"))

    def one(r):
        runs = F.transform(_list(r, "$.contentText.runs"), lambda run: F.coalesce(_get(run, "$.text"), F.lit("")))
        return _entry(
            _get(r, "$.commentId"),
            _get(r, "$.authorText.simpleText"),
            F.array_join(runs, ""),
            _get(r, "$.likeCount"),
            first_nonempty(_get(r, "$.publishedTimeText.simpleText"), _get(r, "$.publishedTime")),
        )

    containers = F.flatten(F.transform(_list(v, ACTIONS), items))
    return F.transform(F.filter(F.transform(containers, renderer), _present), one)


def embedded_json(html: Column) -> Column:
    """JSON assigned in a script, else the whole body, else {}."""
    tries = [F.try_parse_json(F.nullif(F.regexp_extract(html, p, 1), F.lit(""))) for p in EMBEDDED_DATA]
    return F.coalesce(*tries, F.try_parse_json(html), F.parse_json(F.lit("{}")))
