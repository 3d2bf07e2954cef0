"""Gold: the serving relations. Each is recomputed from current silver rows and published as a new generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from palimpsest.operators.joins import spread_columns
from palimpsest.operators.pivot import SOCIAL, fold_max, json_strings
from palimpsest.sources import generations

# Columns of the serving relations.
DEPUTIES = [
    "id", "nomeCivil", "nomeEleitoral", "partido", "estado", "email", "situacao", "condicaoEleitoral",
    "escolaridade", "dataNascimento", "ufNascimento", "municipioNascimento", "sexo", "idLegislatura",
]
PARTIES = [
    "id", "sigla", "nome", "statusData", "statusIdLegislatura", "statusSituacao", "statusTotalPosse",
    "statusTotalMembros", "liderNome", "liderSiglaPartido", "liderUriPartido", "liderUf",
    "liderIdLegislatura", "urlWebSite", "urlFacebook", "loaded_at",
]
PROPOSITIONS = [
    "id", "siglaTipo", "codTipo", "numero", "ano", "ementa", "dataApresentacao", "statusDataHora",
    "statusSequencia", "statusSiglaOrgao", "statusRegime", "statusDescricaoTramitacao",
    "statusCodTipoTramitacao", "statusDescricaoSituacao", "statusCodSituacao", "statusDespacho",
    "statusAmbito", "statusApreciacao", "descricaoTipo", "ementaDetalhada", "tema_classificado",
    "tema_score", "resumo_executivo", "keywords", "loaded_at",
]
VOTINGS = [
    "id", "data", "dataHoraRegistro", "siglaOrgao", "proposicaoObjeto", "descricao", "aprovacao", "loaded_at",
]
# Columns that only the enrichment adds; NULL until it has run.
ENRICHED = {"tema_classificado": "string", "tema_score": "double", "resumo_executivo": "string"}


def gold_deputies(current: DataFrame) -> DataFrame:
    """Current deputies with one link per social network; personal identifiers stay in silver."""
    links = F.col("redeSocial") if "array" in dict(current.dtypes)["redeSocial"] else json_strings("redeSocial")
    folded = current.select(*DEPUTIES, "loaded_at", *fold_max(links, SOCIAL))
    # Rows of one id share their links; rows without an id have none, and are kept apart.
    missing = F.col("id").isNull()
    same = Window.partitionBy("id", F.when(missing, F.xxhash64(*spread_columns(folded))))
    shared = {name: F.when(~missing, F.max(name).over(same)) for name in SOCIAL}
    return folded.withColumns(shared).select(*DEPUTIES, *SOCIAL, "loaded_at")


def gold_parties(latest: DataFrame) -> DataFrame:
    return latest.select(*PARTIES)


def gold_votings(current: DataFrame) -> DataFrame:
    return current.select(*VOTINGS)


def gold_propositions(current: DataFrame) -> DataFrame:
    """Current propositions with topic, score and summary; these are NULL where nothing was enriched yet."""
    missing = {c: F.lit(None).cast(t) for c, t in ENRICHED.items() if c not in current.columns}
    return current.withColumns(missing).select(*PROPOSITIONS) if missing else current.select(*PROPOSITIONS)


def refresh(relation: DataFrame, path: str) -> DataFrame:
    """Materialise a relation in place of its earlier contents, which it may be derived from."""
    spark = relation.sparkSession
    generations.publish(spark, {generations.DATA: relation}, path)
    return generations.read(spark, path, schema=relation.schema)


def publish(spark: SparkSession, relations: dict[str, DataFrame], root: str) -> None:
    """Refresh the relations under ``root``, all at once, and make them available to SQL by name."""
    generations.publish(spark, relations, root)
    for name, relation in relations.items():
        generations.read(spark, root, name, relation.schema).createOrReplaceTempView(name)
