"""Queries over the wide relations, every column checked against a listing of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import history
from palimpsest.plans import gold, silver
from palimpsest.plans.entities import SPECS
from palimpsest.sources.landing import deal_rows
from palimpsest.workload.registry import bronze_record, query, table, time_text

# By parent path the fields of each feed, as field>column where the names differ; :n marks numbers,
# :t timestamps read leniently, :a lists of text.
LISTED = {
    "deputies": """
        detail  uri nomeCivil cpf sexo urlWebsite redeSocial:a dataNascimento dataFalecimento ufNascimento
                municipioNascimento escolaridade
        detail.ultimoStatus  id>ultimoStatusId:n uri>ultimoStatusUri nome>ultimoStatusNome siglaPartido>partido uriPartido
                siglaUf>estado idLegislatura:n urlFoto email data>dataStatus nomeEleitoral situacao condicaoEleitoral
                descricaoStatus
        detail.ultimoStatus.gabinete  nome>gabineteNome predio>gabinetePredio sala>gabineteSala andar>gabineteAndar
                telefone>gabineteTelefone email>gabineteEmail
        summary  id>resumoId:n uri>resumoUri nome>resumoNome siglaPartido>resumoPartido uriPartido>resumoUriPartido
                siglaUf>resumoEstado idLegislatura>resumoIdLegislatura:n urlFoto>resumoUrlFoto email>resumoEmail""",
    "parties": """
        detail  sigla nome uri numeroEleitoral urlLogo urlWebSite urlFacebook
        detail.status  data>statusData idLegislatura>statusIdLegislatura:n situacao>statusSituacao
                totalPosse>statusTotalPosse:n totalMembros>statusTotalMembros:n uriMembros>statusUriMembros
        detail.status.lider  uri>liderUri nome>liderNome siglaPartido>liderSiglaPartido uriPartido>liderUriPartido
                uf>liderUf idLegislatura>liderIdLegislatura:n urlFoto>liderUrlFoto""",
    "propositions": """
        detail  uri siglaTipo codTipo:n numero:n ano:n ementa dataApresentacao:t uriOrgaoNumerador uriAutores
                descricaoTipo ementaDetalhada keywords uriPropPrincipal uriPropAnterior uriPropPosterior urlInteiroTeor
                urnFinal
        detail.statusProposicao  dataHora>statusDataHora:t sequencia>statusSequencia:n siglaOrgao>statusSiglaOrgao
                uriOrgao>statusUriOrgao uriUltimoRelator>statusUriUltimoRelator regime>statusRegime
                descricaoTramitacao>statusDescricaoTramitacao codTipoTramitacao>statusCodTipoTramitacao
                descricaoSituacao>statusDescricaoSituacao codSituacao>statusCodSituacao:n despacho>statusDespacho
                url>statusUrl ambito>statusAmbito apreciacao>statusApreciacao""",
}
# Columns of the serving relations beside the load time.
SERVED = {
    "deputies": """id nomeCivil nomeEleitoral partido estado email situacao condicaoEleitoral escolaridade dataNascimento
        ufNascimento municipioNascimento sexo idLegislatura""",
    "parties": """id sigla nome statusData statusIdLegislatura statusSituacao statusTotalPosse statusTotalMembros liderNome
        liderSiglaPartido liderUriPartido liderUf liderIdLegislatura urlWebSite urlFacebook""",
}
SOURCES = {"deputies": ("customer", "c_custkey"), "parties": ("supplier", "s_suppkey"), "propositions": ("part", "p_partkey")}


def fields(feed):
    """(path, column, kind) of a feed, the record's own ids aside."""
    parent, out = "", []
    for word in LISTED[feed].split():
        if word.split(".")[0] in ("detail", "summary"):
            parent = word
            continue
        name, _, kind = word.partition(":")
        field, _, column = name.partition(">")
        out.append((f"{parent}.{field}", column or field, kind))
    return out


def value_sql(path, kind, key):
    """A field's value made from its path and the record's id, as SQL; every seventh is missing."""
    size = len(path)
    made = {
        "n": f"{key} * 100 + {size}",
        "t": f"strftime(try_cast('2024-01-' || lpad(CAST({key} % 35 + 1 AS VARCHAR), 2, '0') || 'T10:{size}' AS TIMESTAMP),"
        " '%Y-%m-%d %H:%M:%S')",
        "a": f"'https://twitter.com/' || {key} || '|https://www.FaceBook.com/' || {key} || '|https://b.org'",
        "": f"'{path}~' || {key}",
    }[kind]
    return f"CASE WHEN ({key} + {size}) % 7 = 0 THEN NULL ELSE {made} END"


def value(path, kind, key):
    """The same on columns; timestamps and lists as the records have them."""
    size, text = len(path), key.cast("string")
    made = {
        "n": key * 100 + size,
        "t": F.concat(F.lit("2024-01-"), F.lpad((key % 35 + 1).cast("string"), 2, "0"), F.lit(f"T10:{size}")),
        "a": F.array(
            F.concat(F.lit("https://twitter.com/"), text), F.concat(F.lit("https://www.FaceBook.com/"), text), F.lit("https://b.org")
        ),
        "": F.concat(F.lit(f"{path}~"), text),
    }[kind]
    return F.when((key + size) % 7 != 0, made)


def records(spark, sf_dir, feed):
    """Records with every field of the feed, each delivered twice; the second copy has other contents."""
    name, key = SOURCES[feed]
    keys = deal_rows(table(spark, sf_dir, name).select(F.col(key).cast("long").alias("key")))
    rows = keys.select("key", F.explode(F.array(F.lit(0), F.lit(1))).alias("_ordinal"))
    seed = F.col("key") + F.col("_ordinal")
    values = {path: value(path, kind, seed) for path, _, kind in fields(feed)} | {"id": F.col("key")}
    if feed != "parties":
        values["detail.id"] = F.col("key")
    landed = rows.withColumn("source_file", F.lit("delivery_1.json"))
    return bronze_record(landed, SPECS[feed].bronze_schema(), values, "_ordinal", "source_file")


def shown(rows):
    """Lists and times as text, and no NULL."""
    out = []
    for name, kind in rows.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("array"):
            column = F.array_join(column, "|")
        elif kind.startswith("timestamp"):
            column = time_text(column)
        out.append(F.coalesce(column, F.lit(-1 if kind == "bigint" else "none")).alias(name))
    return rows.select(*out)


def shown_sql(feed, only=None):
    name, key = SOURCES[feed]
    listed = {"id": (key, "n")} | ({"deputado_id": (key, "n")} if feed == "deputies" else {})
    listed |= {column: (value_sql(path, kind, key), kind) for path, column, kind in fields(feed)}
    chosen = only or list(listed)
    columns = [f"coalesce(CAST({listed[c][0]} AS {'BIGINT' if listed[c][1] == 'n' else 'VARCHAR'}), {-1 if listed[c][1] == 'n' else repr('none')}) AS \"{c}\"" for c in chosen]
    return f"SELECT {', '.join(columns)}", f"FROM {name}"


def whole(feed):
    return " ".join(shown_sql(feed))


def served(feed, *more):
    select, source = shown_sql(feed, SERVED[feed].split())
    return ", ".join([select, *more, "'2024-02-01 00:00:00' AS loaded_at"]) + f" {source}"


def _silver(spark, sf_dir, feed):
    return silver.transform(records(spark, sf_dir, feed), SPECS[feed])


def _stamped(spark, sf_dir, feed):
    return history.stamp(_silver(spark, sf_dir, feed), F.col("source_file"), F.lit("2024-02-01").cast("timestamp"))


@query(whole("deputies"))
def silver_deputies_wide(spark, sf_dir):
    """All columns of the deputies' table."""
    return shown(_silver(spark, sf_dir, "deputies").drop("source_file"))


@query(whole("parties"))
def silver_parties_wide(spark, sf_dir):
    """All columns of the parties' table."""
    return shown(_silver(spark, sf_dir, "parties").drop("source_file"))


@query(whole("propositions"))
def silver_propositions_wide(spark, sf_dir):
    """All columns of the propositions' table."""
    return shown(_silver(spark, sf_dir, "propositions").drop("source_file"))


_LINKS = value_sql("detail.redeSocial", "a", "c_custkey")


@query(
    served(
        "deputies",
        f"coalesce(split_part({_LINKS}, '|', 1), 'none') AS twitter",
        f"coalesce(split_part({_LINKS}, '|', 2), 'none') AS facebook",
        "'none' AS instagram",
    )
)
def gold_deputies_wide(spark, sf_dir):
    """All columns of the deputies' serving relation."""
    return shown(gold.gold_deputies(history.current_snapshot(_stamped(spark, sf_dir, "deputies"), "source_file")))


@query(served("parties"))
def gold_parties_wide(spark, sf_dir):
    """All columns of the parties' serving relation."""
    return shown(gold.gold_parties(_stamped(spark, sf_dir, "parties")))
