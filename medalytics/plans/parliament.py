"""The parliamentary layers: raw records to typed silver tables, silver tables to gold tables.

Every function takes the DataFrames of its source tables and returns one table under the names that
readers of the open-data layers know. Nothing is read or written here.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import fixed_values as V
from ..operators import anomaly, calendar_ops, engagement, groups, ingest, keys, quality, scd, textmatch
from ..operators.quality import Expectation
from ..sources import pages

# fixed values: raw field, silver column and type of every silver table ------------------------------

DEPUTADOS = [
    ("id", "id_deputado", "bigint"),
    ("nomeCivil", "nome_civil", "string"),
    ("status_nome", "nome_parlamentar", "string"),
    ("cpf", "cpf", "string"),
    ("sexo", "sexo", "string"),
    ("dataNascimento", "data_nascimento", "date"),
    ("municipioNascimento", "municipio_nascimento", "string"),
    ("ufNascimento", "uf_nascimento", "string"),
    ("escolaridade", "escolaridade", "string"),
    ("status_siglaPartido", "sigla_partido", "string"),
    ("status_siglaUf", "sigla_uf", "string"),
    ("status_situacao", "situacao", "string"),
    ("status_condicaoEleitoral", "condicao_eleitoral", "string"),
    ("status_nomeEleitoral", "nome_eleitoral", "string"),
    ("gabinete_nome", "gabinete_nome", "string"),
    ("gabinete_predio", "gabinete_predio", "string"),
    ("gabinete_sala", "gabinete_sala", "string"),
    ("gabinete_andar", "gabinete_andar", "string"),
    ("gabinete_telefone", "gabinete_telefone", "string"),
    ("gabinete_email", "gabinete_email", "string"),
]
DESPESAS = [
    ("_deputado_id", "id_deputado", "bigint"),
    ("ano", "ano", "int"),
    ("mes", "mes", "int"),
    ("tipoDespesa", "categoria_despesa", "string"),
    ("codDocumento", "cod_documento", "string"),
    ("tipoDocumento", "tipo_documento", "string"),
    ("dataDocumento", "data_documento", "date"),
    ("numDocumento", "num_documento", "string"),
    ("valorDocumento", "valor_documento", "decimal(15,2)"),
    ("valorLiquido", "valor_liquido", "decimal(15,2)"),
    ("valorGlosa", "valor_glosa", "decimal(15,2)"),
    ("nomeFornecedor", "nome_fornecedor", "string"),
    ("cnpjCpfFornecedor", "cnpj_cpf_fornecedor", "string"),
    ("urlDocumento", "url_documento", "string"),
    ("numRessarcimento", "num_ressarcimento", "string"),
    ("parcela", "parcela", "int"),
]
EVENTOS = [
    ("id", "id_evento", "bigint"),
    ("dataHoraInicio", "data_hora_inicio", "timestamp"),
    ("dataHoraFim", "data_hora_fim", "timestamp"),
    ("situacao", "situacao", "string"),
    ("descricaoTipo", "tipo_evento", "string"),
    ("descricao", "descricao_evento", "string"),
    ("localExterno", "local", "string"),
]
PRESENCA = [
    ("id", "id_deputado", "bigint"),
    ("_evento_id", "id_evento", "bigint"),
    ("_evento_data", "data_evento", "date"),
    ("_evento_tipo", "tipo_evento", "string"),
    ("siglaPartido", "sigla_partido", "string"),
    ("siglaUf", "sigla_uf", "string"),
]
VOTOS = [
    ("_votacao_id", "id_votacao", "string"),
    ("_votacao_data", "data_votacao", "date"),
    ("_sigla_orgao", "sigla_orgao", "string"),
    ("deputado_.id", "id_deputado", "bigint"),
    ("deputado_.nome", "nome_deputado", "string"),
    ("deputado_.siglaPartido", "sigla_partido", "string"),
    ("deputado_.siglaUf", "sigla_uf", "string"),
    ("tipoVoto", "tipo_voto", "string"),
]
TRAMITACOES = [
    ("_proposicao_id", "id_proposicao", "bigint"),
    ("_sigla_tipo", "sigla_tipo", "string"),
    ("_numero", "numero", "string"),
    ("_ano", "ano", "string"),
    ("sequencia", "sequencia", "int"),
    ("dataHora", "data_hora_tramitacao", "timestamp"),
    ("siglaOrgao", "sigla_orgao", "string"),
    ("regime", "regime", "string"),
    ("descricaoTramitacao", "descricao_tramitacao", "string"),
    ("descricaoSituacao", "situacao", "string"),
    ("codSituacao", "cod_situacao", "int"),
    ("despacho", "despacho", "string"),
    ("ambito", "ambito", "string"),
    ("apreciacao", "apreciacao", "string"),
    ("_payload_hash", "payload_hash", "string"),
]
VOTACOES = [
    ("id", "id_votacao", "string"),
    ("data", "data_votacao", "date"),
    ("dataHoraRegistro", "data_hora_registro", "timestamp"),
    ("siglaOrgao", "sigla_orgao", "string"),
    ("uriEvento", "uri_evento", "string"),
    ("proposicaoObjeto", "proposicao_objeto", "string"),
]
ATLAS = [
    ("_frente_id", "id_frente", "bigint"),
    ("_frente_titulo", "titulo_frente", "string"),
    ("id", "id_deputado", "bigint"),
    ("nome", "nome_deputado", "string"),
    ("siglaPartido", "sigla_partido", "string"),
    ("siglaUf", "sigla_uf", "string"),
    ("titulo", "titulo_na_frente", "string"),
    ("idLegislatura", "id_legislatura", "int"),
]
ORGAOS = [
    ("id", "id_orgao", "bigint"),
    ("sigla", "sigla_cpi", "string"),
    ("nome", "nome_cpi", "string"),
    ("tipoOrgao", "tipo_orgao", "string"),
]

# bronze ------------------------------------------------------------------------------------------

#: Endpoint and fields of every source; columns that start with an underscore are added while landing.
SOURCES = {
    "deputados": ("/deputados", DEPUTADOS),
    "despesas": ("/deputados/despesas", DESPESAS),
    "eventos": ("/eventos", EVENTOS),
    "votos": ("/votacoes/votos", VOTOS),
    "tramitacoes": ("/proposicoes/tramitacoes", TRAMITACOES),
    "votacoes": ("/votacoes", VOTACOES),
    "frentes": ("/frentes/membros", ATLAS),
    "orgaos": ("/orgaos", ORGAOS),
}


def raw_schema(mapping) -> T.StructType:
    """Text fields of a source as they are landed; `a.b` is field b of struct a."""
    nested = {}
    for name, _, _ in mapping:
        if not name.startswith("_"):
            outer, _, inner = name.partition(".")
            nested.setdefault(outer, []).extend([inner] if inner else [])
    texts = lambda names: T.StructType([T.StructField(n, T.StringType()) for n in names])
    return T.StructType([T.StructField(n, texts(inner) if inner else T.StringType()) for n, inner in nested.items()])


def bronze(landed: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """Raw rows of a source out of its pages (`value`, and what was added while landing).

    Fields outside the source's schema stay in `_rescued`; audit columns are added.
    """
    endpoint, mapping = SOURCES[source]
    records = pages.explode_records(landed)
    return ingest.with_audit(pages.rescue(records, "record", raw_schema(mapping)), endpoint, batch_id)


# silver ------------------------------------------------------------------------------------------


def _typed(raw: DataFrame, mapping, key: list[str], sk: str, upper=(), tie: list[str] | None = None) -> DataFrame:
    """Typed rows with their key, standard codes and one row per key."""
    rows = keys.require(keys.project(raw, mapping), key)
    if upper:
        rows = keys.standardize(rows, list(upper))
    rows = keys.surrogate_key(rows, key, sk)
    return keys.dedup_keep_first(rows, key, tie or [c for c in rows.columns if c not in key])


def dim_deputados(detalhes: DataFrame) -> DataFrame:
    return _typed(detalhes, DEPUTADOS, ["id_deputado"], "sk_deputado", ("sigla_partido", "sigla_uf"))


def fato_despesas(despesas: DataFrame, only_digits: bool = False) -> DataFrame:
    rows = keys.require(keys.project(despesas, DESPESAS), ["id_deputado"]).filter("valor_liquido > 0")
    rows = keys.standardize(keys.standardize(rows, ["nome_fornecedor"]), ["cnpj_cpf_fornecedor"], upper=False)
    if only_digits:
        rows = keys.digits_only(rows, ["cnpj_cpf_fornecedor"])
    key = ["id_deputado", "cod_documento", "num_documento"]
    rows = keys.surrogate_key(rows, key, "sk_despesa")
    return keys.dedup_keep_first(rows, key, [c for c in rows.columns if c not in key])


def dim_fornecedores(fato: DataFrame) -> DataFrame:
    return keys.dim_from_fact(
        fato, "cnpj_cpf_fornecedor", "nome_fornecedor", V.TAX_ID_RULES, V.TAX_ID_DEFAULT, "tipo_documento_fiscal", "sk_fornecedor"
    )


def dim_eventos(eventos: DataFrame) -> DataFrame:
    rows = _typed(eventos, EVENTOS, ["id_evento"], "sk_evento")
    start = F.col("data_hora_inicio")
    rows = rows.withColumns({"data_evento": F.to_date(start), "ano": F.year(start), "mes": F.month(start)})
    return calendar_ops.with_week(rows, "data_evento", out="semana_ano")


def fato_presenca(presenca: DataFrame) -> DataFrame:
    return _typed(presenca, PRESENCA, ["id_deputado", "id_evento"], "sk_presenca")


def fato_votos(votos: DataFrame) -> DataFrame:
    rows = _typed(votos, VOTOS, ["id_deputado", "id_votacao"], "sk_voto")
    return keys.recode(rows, "tipo_voto", V.VOTE_RULES, "tipo_voto_padronizado")


def proposicoes_scd2(tramitacoes: DataFrame) -> DataFrame:
    rows = keys.require(keys.project(tramitacoes, TRAMITACOES), ["id_proposicao"])
    rows = keys.surrogate_key(rows, ["id_proposicao", "sequencia"], "sk_tramitacao")
    return scd.build(rows, "id_proposicao", "sequencia", "data_hora_tramitacao")


# the names of the rules are fixed values
def votacoes_rules() -> list[Expectation]:
    """Rules over single vote sessions, of the raw and the typed rows."""
    return [
        Expectation("id_valido", F.col("id_votacao").isNotNull(), "DROP"),
        Expectation("data_valida", F.col("data_votacao").isNotNull() | F.col("data_hora_registro").isNotNull(), "WARN"),
        Expectation("orgao_preenchido", F.col("sigla_orgao") != "", "WARN"),
        Expectation("data_legislatura_57", F.col("data_votacao") >= F.lit(V.FIRST_TERM_DAY).cast("date"), "WARN"),
        Expectation("id_positivo", F.coalesce(F.col("id_votacao").try_cast("bigint") > 0, F.lit(True)), "FAIL"),
    ]


def metricas_rules() -> list[Expectation]:
    """Rules over the groups of the daily metrics."""
    return [
        Expectation("ao_menos_uma_votacao", F.col("total_votacoes") > 0, "WARN"),
        Expectation("orgao_valido", F.col("sigla_orgao").isNotNull(), "WARN"),
    ]


def alertas_rules() -> list[Expectation]:
    """Rules over the sessions that alerts are made of."""
    return [
        Expectation("urgencia_alta", F.col("urgencia_classificada").isin(V.ALERT_LEVELS), "DROP"),
        Expectation("proposicao_presente", F.col("proposicao_objeto").isNotNull(), "WARN"),
    ]


def votacoes_quality(votacoes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean vote sessions, one per id, and the report that is to be enforced before they are written."""
    rows = keys.standardize(keys.project(votacoes, VOTACOES), ["sigla_orgao"])
    clean, report = quality.expect(rows, votacoes_rules())
    report = report.unionByName(quality.uniqueness_report(clean, "id_unico", ["id_votacao"]))
    clean = keys.surrogate_key(clean, ["id_votacao"], "sk_votacao")
    return keys.dedup_keep_first(clean, ["id_votacao"], ["data_hora_registro", "data_votacao", "proposicao_objeto"]), report


def votacoes_camadas(votacoes: DataFrame) -> dict[str, DataFrame]:
    """Sessions, daily metrics and alerts under all ten rules, and their report; a FAIL rule stops here."""
    clean, report = votacoes_quality(votacoes)
    quality.enforce(report)
    metrics = votacoes_metricas(clean)
    body = C.by_body(F.col("sigla_orgao"), V.PLENARY_BODY)
    alerts, alert_report = quality.expect(clean.withColumn("urgencia_classificada", body), alertas_rules())
    report = report.unionByName(quality.expectation_report(metrics, metricas_rules())).unionByName(alert_report)
    return {"votacoes_quality": clean, "votacoes_metricas": metrics, "votacoes_alertas": alerts.filter("proposicao_objeto IS NOT NULL"), "relatorio": report}


# gold --------------------------------------------------------------------------------------------


def _with_member(fact: DataFrame, members: DataFrame, how: str = "left") -> DataFrame:
    return fact.join(members.select("id_deputado", "nome_parlamentar", "sigla_partido", "sigla_uf"), "id_deputado", how)


def gastos_anomalias(despesas: DataFrame, deputados: DataFrame) -> DataFrame:
    scored = anomaly.zscore(_with_member(despesas, deputados), "valor_liquido", ["categoria_despesa", "sigla_uf"])
    return anomaly.anomalies(scored).select(
        "id_deputado", "nome_parlamentar", "sigla_partido", "sigla_uf", "categoria_despesa", "valor_liquido",
        "data_documento", "nome_fornecedor", "cnpj_cpf_fornecedor", "z_score",
        F.col("severity").alias("severidade"), F.col("group_mean").alias("media_cat_uf"),
    )


def ranking_fornecedores(despesas: DataFrame, split_by_name: bool = False) -> DataFrame:
    ranked = anomaly.rank_entities(
        despesas, "cnpj_cpf_fornecedor", "valor_liquido", "id_deputado", "nome_fornecedor", split_by_name=split_by_name
    )
    return ranked.withColumnsRenamed(
        {
            "total_value": "valor_total", "n_documents": "n_documentos", "mean_value": "valor_medio", "max_value": "valor_maximo",
            "n_members": "n_deputados_atendidos", "flag_many_members": "flag_muitos_deputados",
            "flag_high_value": "flag_valor_alto", "flag_person_total": "flag_pf_alto",
        }
    )


def relatorio_mensal_partido(despesas: DataFrame, deputados: DataFrame) -> DataFrame:
    found = anomaly.report(
        _with_member(despesas, deputados), ["sigla_partido", "ano", "mes", "categoria_despesa"], "valor_liquido", "id_deputado"
    )
    return found.withColumnsRenamed(
        {"total_value": "valor_total", "n_rows": "n_despesas", "mean_value": "valor_medio", "n_members": "n_deputados"}
    )


def top_gastos_individuais(despesas: DataFrame, deputados: DataFrame, k: int = 100, per_party: bool = False) -> DataFrame:
    order = [F.col("valor_liquido").desc(), "id_deputado", "cod_documento", "num_documento"]
    found = anomaly.top_k(_with_member(despesas, deputados), order, k, ["sigla_partido"] if per_party else None)
    return found.select(
        "nome_parlamentar", "sigla_partido", "categoria_despesa", "valor_liquido", "nome_fornecedor", "data_documento"
    )


def atlas_frentes(membros: DataFrame) -> DataFrame:
    rows = keys.require(keys.project(membros, ATLAS), ["id_frente", "id_deputado"])
    return keys.dedup_keep_first(rows, ["id_frente", "id_deputado"], ["titulo_frente", "titulo_na_frente"])


def frentes_diversidade(atlas: DataFrame) -> DataFrame:
    found = groups.with_label(groups.hhi(atlas, "id_frente", "sigla_partido"), atlas, "id_frente", "titulo_frente")
    return found.withColumnsRenamed(
        {"n_members": "n_membros_total", "n_parts": "n_partidos", "effective_parts": "diversidade_efetiva"}
    ).orderBy("hhi")


def deputados_multi_frentes(atlas: DataFrame) -> DataFrame:
    lists = groups.memberships(atlas, "id_deputado", "id_frente", "titulo_frente")
    names = atlas.groupBy("id_deputado").agg(*[F.max(c).alias(c) for c in ("nome_deputado", "sigla_partido", "sigla_uf")])
    return names.join(lists, "id_deputado").withColumnsRenamed(
        {"n_groups": "n_frentes", "labels": "lista_frentes", "page": "pagina"}
    ).orderBy(F.col("n_frentes").desc(), "id_deputado", "pagina")


def frentes_sobreposicao(atlas: DataFrame) -> DataFrame:
    pairs = groups.overlap_pairs(atlas, "id_frente", "id_deputado")
    titles = atlas.groupBy("id_frente").agg(F.max("titulo_frente").alias("titulo"))
    for side in ("a", "b"):
        names = titles.select(F.col("id_frente").alias(f"id_frente_{side}"), F.col("titulo").alias(f"frente_{side}"))
        pairs = pairs.join(names, f"id_frente_{side}")
    return pairs.select(
        F.col("id_frente_a").alias("frente_a_id"), "frente_a", F.col("id_frente_b").alias("frente_b_id"), "frente_b",
        F.col("shared").alias("membros_compartilhados"),
    ).orderBy(F.col("membros_compartilhados").desc())


def evolucao_frentes_legislatura(frentes: DataFrame) -> DataFrame:
    found = textmatch.evolution(frentes, "idLegislatura", "titulo")
    return found.withColumnsRenamed({"theme": "tema", "n": "n_frentes"})


_COHESION_NAMES = {
    "mean_cohesion": "indice_coesao_medio", "n_sessions": "n_votacoes_analisadas", "min_cohesion": "coesao_minima", "max_cohesion": "coesao_maxima",
}


def coesao_frentes(votos: DataFrame, atlas: DataFrame) -> DataFrame:
    cast = votos.select("id_deputado", "id_votacao", "tipo_voto_padronizado")
    joined = groups.votes_of_groups(cast, atlas, "id_deputado", "id_frente")
    found = groups.cohesion(joined, "id_frente", "id_votacao", "tipo_voto_padronizado")
    return (
        groups.with_label(found, atlas, "id_frente", "titulo_frente")
        .withColumnsRenamed(_COHESION_NAMES)
        .orderBy(F.col("indice_coesao_medio").desc())
    )


def coesao_partidos(votos: DataFrame) -> DataFrame:
    found = groups.cohesion(votos, "sigla_partido", "id_votacao", "tipo_voto_padronizado")
    return found.select(
        "sigla_partido", F.col("mean_cohesion").alias("indice_coesao_medio"), F.col("n_sessions").alias("n_votacoes")
    ).orderBy(F.col("indice_coesao_medio").desc())


def coesao_comparada(frentes: DataFrame, partidos: DataFrame) -> DataFrame:
    index = F.col("indice_coesao_medio").alias("mean_cohesion")
    return groups.compare_cohesion(frentes.select(index), partidos.select(index), ("frentes", "partidos"))


def taxa_presenca(presenca: DataFrame, eventos: DataFrame) -> DataFrame:
    return engagement.rate(presenca, eventos, "id_evento", "id_deputado", "tipo_evento").withColumnsRenamed(
        {"n_present": "presencas", "n_events": "total_eventos_tipo", "presence_rate": "taxa_presenca"}
    )


def score_engajamento(deputados: DataFrame, presenca: DataFrame, votos: DataFrame, eventos: DataFrame) -> DataFrame:
    presence, voting = V.ENGAGEMENT_WEIGHTS
    parts = [
        ("presenca", presenca, eventos.agg(F.count(F.lit(1))), presence),
        ("votacoes", votos, votos.agg(F.countDistinct("id_votacao")), voting),
    ]
    members = deputados.select("id_deputado", "nome_parlamentar", "sigla_partido", "sigla_uf")
    scored = engagement.percentile(engagement.score(members, "id_deputado", parts), "engagement_score", "percentil")
    return scored.withColumnsRenamed(
        {
            "n_presenca": "total_presencas", "n_votacoes": "total_votos", "presenca_score": "score_presenca",
            "votacoes_score": "score_votacoes", "engagement_score": "score_engajamento",
        }
    )


def padrao_ausencia_votacoes(deputados: DataFrame, votos: DataFrame) -> DataFrame:
    found = engagement.absences(
        deputados, votos, "id_deputado", "id_votacao", "sigla_orgao", ["nome_parlamentar", "sigla_partido"]
    )
    return found.withColumnRenamed("n_missed", "votacoes_perdidas").orderBy(F.col("votacoes_perdidas").desc())


def serie_temporal_engajamento(deputados: DataFrame, presenca: DataFrame, votos: DataFrame, eventos: DataFrame) -> DataFrame:
    days = eventos.select("id_evento", F.to_date("data_hora_inicio").alias("dia"))
    present = presenca.select("id_deputado", "id_evento").join(days, "id_evento")
    cast = votos.withColumnRenamed("data_votacao", "dia")
    series = engagement.monthly_series(present, cast, "id_deputado", "dia", ("presencas_mes", "votos_mes"))
    return (
        series.join(deputados.select("id_deputado", "nome_parlamentar", "sigla_partido"), "id_deputado")
        .withColumnsRenamed({"year": "ano", "month": "mes", "engagement": "engajamento_mes"})
        .orderBy("id_deputado", "ano", "mes")
    )


def calendario_analitico(eventos: DataFrame, presenca: DataFrame) -> DataFrame:
    cal = calendar_ops.calendar(eventos, presenca, "id_evento", "data_hora_inicio", "data_hora_fim")
    return cal.withColumnsRenamed({"n_present": "total_presentes", "hours": "duracao_horas"}).select(
        "id_evento", "data_evento", "data_hora_inicio", "data_hora_fim", "tipo_evento", "situacao", "descricao_evento",
        "ano", "mes", "semana_ano", "total_presentes", "duracao_horas",
    )


def densidade_semanal_eventos(calendario: DataFrame, last: str, first: str = V.WEEK_BASE) -> DataFrame:
    cal = calendario.withColumnRenamed("total_presentes", "n_present")
    return calendar_ops.weekly_density(cal, "data_evento", "tipo_evento", first, last).withColumnsRenamed(
        {
            "week": "semana_ano", "n_events": "n_eventos", "n_present": "total_presentes_semana",
            "mean_present": "media_presentes_evento", "kinds": "tipos_eventos", "is_empty": "semanas_sem_atividade",
        }
    )


def comparativo_eleitoral(presenca: DataFrame, eventos: DataFrame) -> DataFrame:
    facts = presenca.select("id_deputado", "id_evento").join(eventos.select("id_evento", "ano", "mes"), "id_evento")
    found = calendar_ops.period_compare(facts, "id_deputado", C.election_period(F.col("ano"), F.col("mes")))
    return found.withColumnsRenamed({"period": "periodo", "mean_per_member": "media_presencas", "n_members": "n_deputados"})


def eventos_futuros_agendados(calendario: DataFrame, as_of: str | None = None) -> DataFrame:
    return calendar_ops.upcoming(calendario, "data_hora_inicio", "situacao", as_of)


def cpis(orgaos: DataFrame) -> DataFrame:
    return keys.project(textmatch.contains_any(orgaos, V.INQUIRY_MARKS), ORGAOS)


def cpis_timeline(comissoes: DataFrame, eventos: DataFrame) -> DataFrame:
    """Committees with status, first and last event that names them, events and days between."""
    found = textmatch.mention_timeline(
        eventos, "id_evento", "data_hora_inicio", "descricao_evento", comissoes, "id_orgao", ["sigla_cpi", "nome_cpi"]
    )
    return textmatch.with_status(found, "tipo_orgao").withColumnsRenamed(
        {"first_at": "primeiro_evento", "last_at": "ultimo_evento", "n_mentions": "n_eventos", "days": "duracao_dias"}
    )


def cpis_legislacao_derivada(comissoes: DataFrame, proposicoes: DataFrame) -> DataFrame:
    kept = ["id", "siglaTipo", "numero", "ano", "ementa"]
    pairs = textmatch.mentions(proposicoes, comissoes, "ementa", "id_orgao", ["sigla_cpi"], kept)
    return pairs.join(comissoes.select("id_orgao", "sigla_cpi"), "id_orgao").withColumnsRenamed(
        {"id_orgao": "id_cpi", "id": "id_proposicao", "siglaTipo": "tipo_proposicao"}
    )


def cpis_produtividade(timeline: DataFrame, derivadas: DataFrame) -> DataFrame:
    return textmatch.flag_exists(timeline, derivadas.withColumnRenamed("id_cpi", "id_orgao"), "id_orgao", "gerou_legislacao")


def tempo_medio_tramitacao(historico: DataFrame) -> DataFrame:
    found = scd.durations(historico, ["id_proposicao", "sigla_tipo"], "sigla_orgao")
    return found.withColumnsRenamed(
        {
            "first_at": "primeira_tramitacao", "last_at": "ultima_tramitacao", "n_steps": "total_tramitacoes",
            "last_body": "comissao_relatora", "days": "duracao_dias",
        }
    )


def tempo_por(duracao: DataFrame, by: str, min_n: int = 1) -> DataFrame:
    """Mean days by type, or by last body with at least 5 bills, of a table of durations."""
    found = scd.duration_summary(duracao.withColumnRenamed("duracao_dias", "days"), by, min_n)
    return found.withColumnsRenamed(
        {"mean_days": "tempo_medio_dias", "n_keys": "n_proposicoes", "min_days": "min_dias", "max_days": "max_dias"}
    )


def em_plenario(historico: DataFrame) -> DataFrame:
    return scd.current_alerts(historico, "sigla_orgao", "situacao", V.PLENARY_BODY, V.PLENARY_STATE)


def arquivadas(historico: DataFrame) -> DataFrame:
    return scd.current_in_state(historico, "situacao", V.ARCHIVED_STATE)


def votacoes_metricas(votacoes: DataFrame) -> DataFrame:
    return votacoes.groupBy("data_votacao", "sigla_orgao").agg(
        F.count(F.lit(1)).alias("total_votacoes"), F.count("proposicao_objeto").alias("com_proposicao")
    )


def votacoes_alertas(votacoes: DataFrame) -> DataFrame:
    urgent = textmatch.urgency_by_body(votacoes, "proposicao_objeto", "sigla_orgao").withColumnRenamed(
        "urgency", "urgencia_classificada"
    )
    return urgent.filter(F.col("urgencia_classificada").isin(V.ALERT_LEVELS))
