"""The four feeds: record shapes, silver columns, keys and load strategies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Source path, silver column, type, and whether the value is read as text and parsed leniently, so
# that one that does not parse becomes NULL. One column per line, in table order.
DEPUTIES = (
    ("id", "deputado_id", "bigint", False),
    ("detail.id", "id", "bigint", False),
    ("detail.uri", "uri", "string", False),
    ("detail.nomeCivil", "nomeCivil", "string", False),
    ("detail.cpf", "cpf", "string", False),
    ("detail.sexo", "sexo", "string", False),
    ("detail.urlWebsite", "urlWebsite", "string", False),
    ("detail.redeSocial", "redeSocial", "array<string>", False),
    ("detail.dataNascimento", "dataNascimento", "string", False),
    ("detail.dataFalecimento", "dataFalecimento", "string", False),
    ("detail.ufNascimento", "ufNascimento", "string", False),
    ("detail.municipioNascimento", "municipioNascimento", "string", False),
    ("detail.escolaridade", "escolaridade", "string", False),
    ("detail.ultimoStatus.id", "ultimoStatusId", "bigint", False),
    ("detail.ultimoStatus.uri", "ultimoStatusUri", "string", False),
    ("detail.ultimoStatus.nome", "ultimoStatusNome", "string", False),
    ("detail.ultimoStatus.siglaPartido", "partido", "string", False),
    ("detail.ultimoStatus.uriPartido", "uriPartido", "string", False),
    ("detail.ultimoStatus.siglaUf", "estado", "string", False),
    ("detail.ultimoStatus.idLegislatura", "idLegislatura", "bigint", False),
    ("detail.ultimoStatus.urlFoto", "urlFoto", "string", False),
    ("detail.ultimoStatus.email", "email", "string", False),
    ("detail.ultimoStatus.data", "dataStatus", "string", False),
    ("detail.ultimoStatus.nomeEleitoral", "nomeEleitoral", "string", False),
    ("detail.ultimoStatus.gabinete.nome", "gabineteNome", "string", False),
    ("detail.ultimoStatus.gabinete.predio", "gabinetePredio", "string", False),
    ("detail.ultimoStatus.gabinete.sala", "gabineteSala", "string", False),
    ("detail.ultimoStatus.gabinete.andar", "gabineteAndar", "string", False),
    ("detail.ultimoStatus.gabinete.telefone", "gabineteTelefone", "string", False),
    ("detail.ultimoStatus.gabinete.email", "gabineteEmail", "string", False),
    ("detail.ultimoStatus.situacao", "situacao", "string", False),
    ("detail.ultimoStatus.condicaoEleitoral", "condicaoEleitoral", "string", False),
    ("detail.ultimoStatus.descricaoStatus", "descricaoStatus", "string", False),
    ("summary.id", "resumoId", "bigint", False),
    ("summary.uri", "resumoUri", "string", False),
    ("summary.nome", "resumoNome", "string", False),
    ("summary.siglaPartido", "resumoPartido", "string", False),
    ("summary.uriPartido", "resumoUriPartido", "string", False),
    ("summary.siglaUf", "resumoEstado", "string", False),
    ("summary.idLegislatura", "resumoIdLegislatura", "bigint", False),
    ("summary.urlFoto", "resumoUrlFoto", "string", False),
    ("summary.email", "resumoEmail", "string", False),
)

PARTIES = (
    ("id", "id", "bigint", False),
    ("detail.sigla", "sigla", "string", False),
    ("detail.nome", "nome", "string", False),
    ("detail.uri", "uri", "string", False),
    ("detail.status.data", "statusData", "string", False),
    ("detail.status.idLegislatura", "statusIdLegislatura", "bigint", False),
    ("detail.status.situacao", "statusSituacao", "string", False),
    ("detail.status.totalPosse", "statusTotalPosse", "bigint", False),
    ("detail.status.totalMembros", "statusTotalMembros", "bigint", False),
    ("detail.status.uriMembros", "statusUriMembros", "string", False),
    ("detail.status.lider.uri", "liderUri", "string", False),
    ("detail.status.lider.nome", "liderNome", "string", False),
    ("detail.status.lider.siglaPartido", "liderSiglaPartido", "string", False),
    ("detail.status.lider.uriPartido", "liderUriPartido", "string", False),
    ("detail.status.lider.uf", "liderUf", "string", False),
    ("detail.status.lider.idLegislatura", "liderIdLegislatura", "bigint", False),
    ("detail.status.lider.urlFoto", "liderUrlFoto", "string", False),
    ("detail.numeroEleitoral", "numeroEleitoral", "string", False),
    ("detail.urlLogo", "urlLogo", "string", False),
    ("detail.urlWebSite", "urlWebSite", "string", False),
    ("detail.urlFacebook", "urlFacebook", "string", False),
)

PROPOSITIONS = (
    ("id", "id", "bigint", False),
    ("detail.uri", "uri", "string", False),
    ("detail.siglaTipo", "siglaTipo", "string", False),
    ("detail.codTipo", "codTipo", "bigint", False),
    ("detail.numero", "numero", "bigint", False),
    ("detail.ano", "ano", "bigint", False),
    ("detail.ementa", "ementa", "string", False),
    ("detail.dataApresentacao", "dataApresentacao", "timestamp_ntz", True),
    ("detail.uriOrgaoNumerador", "uriOrgaoNumerador", "string", False),
    ("detail.statusProposicao.dataHora", "statusDataHora", "timestamp_ntz", True),
    ("detail.statusProposicao.sequencia", "statusSequencia", "bigint", False),
    ("detail.statusProposicao.siglaOrgao", "statusSiglaOrgao", "string", False),
    ("detail.statusProposicao.uriOrgao", "statusUriOrgao", "string", False),
    ("detail.statusProposicao.uriUltimoRelator", "statusUriUltimoRelator", "string", False),
    ("detail.statusProposicao.regime", "statusRegime", "string", False),
    ("detail.statusProposicao.descricaoTramitacao", "statusDescricaoTramitacao", "string", False),
    ("detail.statusProposicao.codTipoTramitacao", "statusCodTipoTramitacao", "string", False),
    ("detail.statusProposicao.descricaoSituacao", "statusDescricaoSituacao", "string", False),
    ("detail.statusProposicao.codSituacao", "statusCodSituacao", "bigint", False),
    ("detail.statusProposicao.despacho", "statusDespacho", "string", False),
    ("detail.statusProposicao.url", "statusUrl", "string", False),
    ("detail.statusProposicao.ambito", "statusAmbito", "string", False),
    ("detail.statusProposicao.apreciacao", "statusApreciacao", "string", False),
    ("detail.uriAutores", "uriAutores", "string", False),
    ("detail.descricaoTipo", "descricaoTipo", "string", False),
    ("detail.ementaDetalhada", "ementaDetalhada", "string", False),
    ("detail.keywords", "keywords", "string", False),
    ("detail.uriPropPrincipal", "uriPropPrincipal", "string", False),
    ("detail.uriPropAnterior", "uriPropAnterior", "string", False),
    ("detail.uriPropPosterior", "uriPropPosterior", "string", False),
    ("detail.urlInteiroTeor", "urlInteiroTeor", "string", False),
    ("detail.urnFinal", "urnFinal", "string", False),
)

VOTINGS = (
    ("id", "id", "string", False),
    ("uri", "uri", "string", False),
    ("data", "data", "date", True),
    ("dataHoraRegistro", "dataHoraRegistro", "timestamp_ntz", True),
    ("siglaOrgao", "siglaOrgao", "string", False),
    ("uriOrgao", "uriOrgao", "string", False),
    ("uriEvento", "uriEvento", "string", False),
    ("proposicaoObjeto", "proposicaoObjeto", "string", False),
    ("uriProposicaoObjeto", "uriProposicaoObjeto", "string", False),
    ("descricao", "descricao", "string", False),
    ("aprovacao", "aprovacao", "int", False),
)


@dataclass(frozen=True)
class TableSpec:
    """How one feed becomes one silver table."""

    endpoint: str
    table: str
    columns: tuple[tuple[str, str, str, bool], ...]
    strategy: str
    file_pattern: str
    pk: str = "id"
    record_key: str = "id"
    order_by: str = "id"
    mark: str | None = None

    def bronze_schema(self) -> T.StructType:
        """Schema of the bronze records, as deep as the silver columns need it."""
        tree: dict = {}
        for path, _, kind, lenient in self.columns:
            *parents, leaf = path.split(".")
            node = tree
            for parent in parents:
                node = node.setdefault(parent, {})
            node[leaf] = "string" if lenient else kind
        tree.setdefault(self.record_key, "bigint")
        return _struct(tree)

    def silver_schema(self) -> T.StructType:
        """Schema of the version log, without the batch it is partitioned by."""
        named = [f"`{name}` {kind}" for _, name, kind, _ in self.columns]
        return T.StructType.fromDDL(", ".join(named + ["loaded_at timestamp", "source_file string"]))


def _struct(tree: dict) -> T.StructType:
    fields = []
    for name, kind in tree.items():
        nested = _struct(kind) if isinstance(kind, dict) else T.StructType.fromDDL(f"x {kind}")["x"].dataType
        fields.append(T.StructField(name, nested))
    return T.StructType(fields)


# Table names, load strategies and file patterns per feed.
SPECS = {
    "deputies": TableSpec(
        "deputies", "silver_deputies", DEPUTIES, "snapshot", "snapshot_*.json", order_by="nome"
    ),
    "parties": TableSpec(
        "parties", "silver_parties", PARTIES, "overwrite", "snapshot_*.json", order_by="sigla"
    ),
    "votings": TableSpec(
        "votings",
        "silver_votings",
        VOTINGS,
        "delta",
        "delta_*.json",
        order_by="dataHoraRegistro",
        mark="dataHoraRegistro",
    ),
    "propositions": TableSpec(
        "propositions",
        "silver_propositions",
        PROPOSITIONS,
        "delta",
        "delta_*.json",
        mark="dataApresentacao",
    ),
}

# The topics and their descriptions. The order decides ties.
TOPICS = [
    ("Tributário", "Impostos, taxas, contribuições, reforma tributária, isenções fiscais, Imposto de Renda, ICMS, IPI, PIS, COFINS, simples nacional."),
    ("Saúde", "SUS, hospitais, medicamentos, planos de saúde, vigilância sanitária, doenças, vacinas, saúde mental, profissionais de saúde."),
    ("Educação", "Escolas, universidades, ensino básico, ensino superior, MEC, professores, bolsas de estudo, ENEM, alfabetização, FUNDEB."),
    ("Segurança Pública", "Polícia, crime, violência, presídios, drogas, armas, tráfico, lei penal, código penal, segurança nas cidades."),
    ("Meio Ambiente", "Desmatamento, clima, sustentabilidade, poluição, reciclagem, Amazônia, unidades de conservação, agrotóxicos, biodiversidade."),
    ("Economia e Trabalho", "Emprego, desemprego, salário mínimo, CLT, previdência social, FGTS, sindicatos, reforma trabalhista, microempresas, desenvolvimento econômico."),
    ("Infraestrutura e Transporte", "Rodovias, ferrovias, portos, aeroportos, mobilidade urbana, saneamento, energia elétrica, habitação, obras públicas."),
    ("Direitos Humanos e Minorias", "Igualdade racial, gênero, LGBTQi+, pessoas com deficiência, indígenas, quilombolas, direitos da criança, idosos, refugiados."),
    ("Administração Pública", "Funcionalismo público, concursos, licitações, transparência, controle, TCU, CGU, reforma administrativa, servidores federais."),
    ("Agropecuária", "Agricultura familiar, agronegócio, crédito rural, reforma agrária, defensivos, irrigação, pecuária, FUNRURAL, produção de alimentos."),
]
