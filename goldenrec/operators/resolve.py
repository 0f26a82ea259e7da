"""Entity resolution: by document, then by e-mail of a documented record, else alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.joins import shuffled_alone
from goldenrec.schemas import CLUSTER

# Match methods, strongest first, and the key prefixes.
DOC_MATCH = "doc_match"
EMAIL_MATCH = "email_to_doc_match"
SINGLETON = "singleton"
DOC_PREFIX = "doc:"
ALONE_PREFIX = "lone:"


def _doc_key() -> Column:
    return F.when(F.col("cpf_cnpj_valido"), F.concat(F.lit(DOC_PREFIX), F.col("cpf_cnpj")))


def email_owners(silver: DataFrame) -> DataFrame:
    """``email -> cluster_via_email``: the smallest document cluster that uses the address."""
    return (
        silver.where(
            F.col("cpf_cnpj_valido") & F.col("cpf_cnpj").isNotNull() & F.col("email").isNotNull()
        )
        .groupBy("email")
        .agg(F.min(_doc_key()).alias("cluster_via_email"))
    )


def documented() -> Column:
    """Rows that name their cluster themselves, and may own an e-mail address; never NULL."""
    return F.coalesce(F.col("cpf_cnpj_valido"), F.lit(False)) & F.col("cpf_cnpj").isNotNull()


def resolve_entities(silver: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Silver plus ``cluster_key`` and ``match_method``, with the columns ``keep`` behind them.

    Only rows that lack a valid document but have an e-mail can gain from the owner lookup, so
    only they are shuffled for it; an address that many of them share sits on the many side of the
    join, where adaptive execution splits the partition. Matching is one step: two records
    without a document never join through a shared address.
    """
    valid, doc, email = F.col("cpf_cnpj_valido"), F.col("cpf_cnpj"), F.col("email")
    documented = valid & doc.isNotNull()
    # plain comparisons, NULLs spelt out, so that both filters reach the file scan
    undocumented = valid.isNull() | ~valid | doc.isNull()
    alone = F.concat(F.lit(ALONE_PREFIX), F.col("id_unicad"))
    direct = silver.where(documented | email.isNull()).withColumns(
        {
            "cluster_key": F.when(documented, _doc_key()).otherwise(alone),
            "match_method": F.when(documented, DOC_MATCH).otherwise(SINGLETON),
        }
    )
    owner = F.col("cluster_via_email")
    by_email = (
        silver.where(undocumented & email.isNotNull())
        .join(shuffled_alone(email_owners(silver), "email"), "email", "left")
        .withColumns(
            {
                "cluster_key": F.coalesce(owner, alone),
                "match_method": F.when(owner.isNotNull(), EMAIL_MATCH).otherwise(SINGLETON),
            }
        )
    )
    names = [*CLUSTER.fieldNames(), *keep]
    return direct.select(names).unionByName(by_email.select(names))
