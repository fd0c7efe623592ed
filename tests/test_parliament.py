"""The parliamentary layers from raw records to gold on a small parliament."""

import json

import pytest
from pyspark.sql import functions as F

from medalytics.operators import quality
from medalytics.plans import parliament as P
from medalytics.sources import pages


def raw(spark, mapping, rows, extra=""):
    """Raw all-text table with the source fields of a mapping; missing fields are null."""
    names = [source for source, _, _ in mapping]
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture(scope="module")
def members(spark):
    rows = [
        {"id": "1", "status_nome": "Ana", "status_siglaPartido": " pa ", "status_siglaUf": "sp", "dataNascimento": "1970-02-01"},
        {"id": "2", "status_nome": "Rui", "status_siglaPartido": "PB", "status_siglaUf": "RJ", "dataNascimento": ""},
        {"id": "2", "status_nome": "Rui", "status_siglaPartido": "PB", "status_siglaUf": "RJ"},
        {"id": None, "status_nome": "Ninguém"},
    ]
    return P.dim_deputados(raw(spark, P.DEPUTADOS, rows))


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        {"id": "10", "dataHoraInicio": "2024-03-05T10:00", "dataHoraFim": "2024-03-05T12:30", "situacao": "Encerrada", "descricaoTipo": "Sessão", "descricao": "Reunião da CPIX"},
        {"id": "11", "dataHoraInicio": "2024-08-01T10:00", "dataHoraFim": "", "situacao": "Agendada", "descricaoTipo": "Audiência", "descricao": "Comissão Parlamentar de Inquérito X"},
    ]
    return P.dim_eventos(raw(spark, P.EVENTOS, rows))


@pytest.fixture(scope="module")
def presence(spark):
    rows = [{"id": "1", "_evento_id": "10"}, {"id": "1", "_evento_id": "10"}, {"id": "1", "_evento_id": "11"}, {"id": "2", "_evento_id": "10"}, {"id": "1"}]
    return P.fato_presenca(raw(spark, P.PRESENCA, rows))


@pytest.fixture(scope="module")
def votes(spark):
    data = [("v1", "1", "Sim"), ("v1", "2", "Não"), ("v2-a", "1", "Sim"), ("v2-a", "1", "Sim")]
    df = spark.createDataFrame(data, "_votacao_id string, d string, tipoVoto string")
    party = F.when(F.col("d") == "1", "PA").otherwise("PB")
    person = F.struct(F.col("d").alias("id"), F.lit("n").alias("nome"), party.alias("siglaPartido"), F.lit("SP").alias("siglaUf"))
    return P.fato_votos(df.select("_votacao_id", F.lit("2024-03-06").alias("_votacao_data"), F.lit("PLEN").alias("_sigla_orgao"), person.alias("deputado_"), "tipoVoto"))


@pytest.fixture(scope="module")
def atlas(spark):
    rows = [("1", "Saúde", "1", "PA"), ("1", "Saúde", "2", "PB"), ("2", "Rural", "1", "PA"), ("2", "Rural", "1", "PA"), ("2", "Rural", "2", "PB"), ("x", "?", "1", "PA")]
    return P.atlas_frentes(raw(spark, P.ATLAS, [{"_frente_id": f, "_frente_titulo": t, "id": m, "siglaPartido": p} for f, t, m, p in rows]))


def expenses(spark, only_digits=False):
    rows = [
        {"_deputado_id": "1", "ano": "2024", "mes": "3", "tipoDespesa": "COMBUSTÍVEIS", "codDocumento": str(i), "numDocumento": "a", "valorLiquido": "10.00", "nomeFornecedor": " posto ", "cnpjCpfFornecedor": " 123.456.789-01", "dataDocumento": "2024-03-01"}
        for i in range(30)
    ]
    rows += [dict(rows[0], codDocumento="99", valorLiquido="200000.00"), dict(rows[0]), dict(rows[0], codDocumento="98", valorLiquido="-1"), dict(rows[0], codDocumento="97", valorLiquido="abc"), dict(rows[0], _deputado_id="2", codDocumento="50")]
    return P.fato_despesas(raw(spark, P.DESPESAS, rows), only_digits)


def test_members(members):
    got = {r["id_deputado"]: r for r in members.collect()}
    assert set(got) == {1, 2}
    assert (got[1]["sigla_partido"], got[1]["sigla_uf"], str(got[1]["data_nascimento"])) == ("PA", "SP", "1970-02-01")
    assert got[1]["sk_deputado"] == "c4ca4238a0b923820dcc509a6f75849b"


def test_expenses_to_gold(spark, members):
    fact = expenses(spark)
    assert fact.count() == 32 and fact.first()["nome_fornecedor"] == "POSTO"
    assert P.dim_fornecedores(fact).first()["tipo_documento_fiscal"] == "OUTRO"
    assert P.dim_fornecedores(expenses(spark, True)).first()["tipo_documento_fiscal"] == "CPF"
    alert = P.gastos_anomalias(fact, members).collect()
    assert [(r["nome_parlamentar"], r["severidade"]) for r in alert] == [("Ana", "CRITICA")]
    ranked = P.ranking_fornecedores(expenses(spark, True)).first()
    assert (ranked["n_documentos"], ranked["n_deputados_atendidos"], ranked["flag_valor_alto"], ranked["flag_pf_alto"], ranked["n_flags"]) == (32, 2, True, True, 2)
    monthly = {r["sigla_partido"]: (r["n_despesas"], r["n_deputados"]) for r in P.relatorio_mensal_partido(fact, members).collect()}
    assert monthly == {"PA": (31, 1), "PB": (1, 1)}
    assert str(P.top_gastos_individuais(fact, members).first()["valor_liquido"]) == "200000.00"
    assert P.top_gastos_individuais(fact, members, 10, per_party=True).count() == 11


def test_votes(votes):
    got = sorted((r["id_votacao"], r["id_deputado"], r["tipo_voto_padronizado"]) for r in votes.collect())
    assert got == [("v1", 1, "SIM"), ("v1", 2, "NAO"), ("v2-a", 1, "SIM")]


def test_engagement(members, presence, votes, events):
    assert presence.count() == 3
    got = {r["id_deputado"]: r for r in P.score_engajamento(members, presence, votes, events).collect()}
    assert got[1]["score_engajamento"] == pytest.approx(1.0) and got[2]["score_engajamento"] == pytest.approx(0.5)
    assert (got[1]["percentil"], got[2]["percentil"]) == (1.0, 0.0)
    rates = {(r["id_deputado"], r["tipo_evento"]): r["taxa_presenca"] for r in P.taxa_presenca(presence, events).collect()}
    assert rates == {(1, "Sessão"): 1.0, (2, "Sessão"): 1.0, (1, "Audiência"): 1.0}
    missed = [(r["id_deputado"], r["sigla_orgao"], r["votacoes_perdidas"]) for r in P.padrao_ausencia_votacoes(members, votes).collect()]
    assert missed == [(2, "PLEN", 1)]
    series = {(r["id_deputado"], r["mes"]): (r["presencas_mes"], r["votos_mes"]) for r in P.serie_temporal_engajamento(members, presence, votes, events).collect()}
    assert series == {(1, 3): (1, 2), (1, 8): (1, 0), (2, 3): (1, 1)}


def test_calendar(events, presence):
    cal = P.calendario_analitico(events, presence)
    got = {r["id_evento"]: (r["total_presentes"], r["duracao_horas"], r["semana_ano"]) for r in cal.collect()}
    assert got == {10: (2, 2.5, 62), 11: (1, None, 83)}
    weeks = P.densidade_semanal_eventos(cal, "2024-12-31").collect()
    assert sum(r["n_eventos"] for r in weeks) == 2 and sum(r["semanas_sem_atividade"] for r in weeks) == len(weeks) - 2
    periods = {r["periodo"]: (r["media_presencas"], r["n_deputados"]) for r in P.comparativo_eleitoral(presence, events).collect()}
    assert periods == {"PRE_ELEITORAL": (1.0, 2), "ELEITORAL": (1.0, 1)}
    assert [r["id_evento"] for r in P.eventos_futuros_agendados(cal, "2024-01-01").collect()] == [11]


def test_caucuses(spark, atlas, votes):
    assert atlas.count() == 4
    assert {r["id_frente"]: round(r["hhi"], 6) for r in P.frentes_diversidade(atlas).collect()} == {1: 0.5, 2: 0.5}
    assert P.deputados_multi_frentes(atlas).first()["lista_frentes"] == ["Rural", "Saúde"]
    assert [tuple(r) for r in P.frentes_sobreposicao(atlas).collect()] == [(1, "Saúde", 2, "Rural", 2)]
    fronts = P.coesao_frentes(votes, atlas)
    assert {r["id_frente"]: r["indice_coesao_medio"] for r in fronts.collect()} == {1: 0.75, 2: 0.75}
    parties = P.coesao_partidos(votes)
    assert {r["sigla_partido"]: r["n_votacoes"] for r in parties.collect()} == {"PA": 2, "PB": 1}
    assert P.coesao_comparada(fronts, parties).first()["verdict"] == "partidos"
    titles = spark.createDataFrame([("57", "Frente Rural"), ("57", "Frente do CAMPO"), ("56", "Cinema")], "idLegislatura string, titulo string")
    assert [tuple(r) for r in P.evolucao_frentes_legislatura(titles).collect()] == [("56", "Outros", 1), ("57", "Agropecuária", 2)]


def test_bills(spark):
    rows = [
        {"_proposicao_id": "1", "_sigla_tipo": "PL", "sequencia": s, "dataHora": t, "siglaOrgao": o, "descricaoSituacao": d}
        for s, t, o, d in [("9", "2024-01-01T10:00", "CCJ", "a"), ("10", "2024-02-10T10:00", "PLEN", "Arquivada")]
    ]
    history = P.proposicoes_scd2(raw(spark, P.TRAMITACOES, rows))
    assert [r["sequencia"] for r in P.em_plenario(history).collect()] == [10] == [r["sequencia"] for r in P.arquivadas(history).collect()]
    spans = P.tempo_medio_tramitacao(history)
    assert spans.first()["duracao_dias"] == 40 and spans.first()["comissao_relatora"] == "PLEN"
    assert P.tempo_por(spans, "sigla_tipo").first()["tempo_medio_dias"] == 40.0
    assert P.tempo_por(spans, "comissao_relatora", 5).count() == 0


def test_inquiries(spark, events):
    bodies = spark.createDataFrame(
        [("1", "CPIX", "Comissão Parlamentar de Inquérito X", "CPI"), ("2", "CPIY", "Y", "CPI Encerrada"), ("3", "CCJ", "Justiça", None)],
        "id string, sigla string, nome string, tipoOrgao string",
    )
    found = P.cpis(bodies)
    timeline = P.cpis_timeline(found, events)
    got = {r["sigla_cpi"]: (r["n_eventos"], r["duracao_dias"], r["status"]) for r in timeline.collect()}
    assert got == {"CPIX": (2, 149, "ATIVA"), "CPIY": (0, None, "ENCERRADA")}
    bills = spark.createDataFrame([("7", "PL", "1", "2024", "Decorre da CPIX.")], "id string, siglaTipo string, numero string, ano string, ementa string")
    derived = P.cpis_legislacao_derivada(found, bills)
    assert [(r["id_cpi"], r["id_proposicao"]) for r in derived.collect()] == [(1, "7")]
    assert {r["sigla_cpi"]: r["gerou_legislacao"] for r in P.cpis_produtividade(timeline, derived).collect()} == {"CPIX": True, "CPIY": False}


def test_vote_sessions(spark):
    rows = [
        {"id": "5", "data": "2024-01-01", "siglaOrgao": " plen ", "proposicaoObjeto": "PEC 1"},
        {"id": "5", "data": "2024-01-01", "siglaOrgao": "PLEN", "proposicaoObjeto": "PEC 1"},
        {"id": "6-a", "data": "2020-01-01", "siglaOrgao": None},
        {"id": None},
    ]
    clean, report = P.votacoes_quality(raw(spark, P.VOTACOES, rows))
    quality.enforce(report)
    assert {r["rule"]: r["failed"] for r in report.collect()} == {"id_valido": 1, "data_valida": 1, "orgao_preenchido": 2, "data_legislatura_57": 2, "id_positivo": 0, "id_unico": 1}
    assert clean.count() == 2
    assert {(r["sigla_orgao"], r["total_votacoes"], r["com_proposicao"]) for r in P.votacoes_metricas(clean).collect()} == {("PLEN", 1, 1), (None, 1, 0)}
    assert [r["urgencia_classificada"] for r in P.votacoes_alertas(clean).collect()] == ["CRITICA"]
    layers = P.votacoes_camadas(raw(spark, P.VOTACOES, rows))
    report = {r["rule"]: (r["total"], r["failed"], r["action"]) for r in layers["relatorio"].collect()}
    assert len(report) == 10 and report["ao_menos_uma_votacao"] == (2, 0, "WARN") and report["orgao_valido"] == (2, 1, "WARN")
    assert report["urgencia_alta"] == (2, 1, "DROP") and report["proposicao_presente"] == (2, 1, "WARN")
    assert [r["urgencia_classificada"] for r in layers["votacoes_alertas"].collect()] == ["CRITICA"]
    with pytest.raises(quality.ExpectationFailed):
        P.votacoes_camadas(raw(spark, P.VOTACOES, [{"id": "-3"}]))
    _, report = P.votacoes_quality(raw(spark, P.VOTACOES, [{"id": "-3"}]))
    with pytest.raises(quality.ExpectationFailed):
        quality.enforce(report)


def test_nested_member_record_to_dimension(spark):
    record = '{"dados": {"id": 4, "nomeCivil": "Ana", "redes": ["x"], "ultimoStatus": {"nome": "Ana", "siglaPartido": "pa", "gabinete": {"nome": "5"}}}}'
    schema = spark.sql("SELECT named_struct('id', '', 'nomeCivil', '', 'redes', array(''), 'ultimoStatus', named_struct('nome', '', 'siglaPartido', '', 'gabinete', named_struct('nome', ''))) AS s").schema["s"].dataType
    flat = pages.flatten_struct(pages.explode_envelope(spark.createDataFrame([(record,)], "value string"), schema), {"ultimoStatus": "status_", "ultimoStatus.gabinete": "gabinete_"})
    wanted = [m for m in P.DEPUTADOS if m[0] in flat.columns]
    assert len(wanted) == 5 and flat.first()["gabinete_nome"] == "5"


def test_page_files_to_bronze_and_silver(spark, tmp_path):
    """Files of two pages, one a single object; a field nobody knows is rescued; numbers arrive as text."""
    folder = tmp_path / "despesas"
    folder.mkdir()
    line = lambda code, value, **more: {"codDocumento": code, "tipoDespesa": "A", "valorDocumento": value, **more}
    (folder / "1.json").write_text(json.dumps({"dados": [line("1", 5.5), line("2", "7", novo={"x": 1})], "links": [{"rel": "next"}]}))
    (folder / "2.json").write_text(json.dumps({"dados": line("3", 8)}))
    (folder / "3.json").write_text(json.dumps({"dados": []}))
    landed = pages.read_pages(spark, str(folder)).select("value", F.lit("9").alias("_deputado_id"))
    rows = P.bronze(landed, "despesas", "b").orderBy("codDocumento").collect()
    assert [(r["codDocumento"], r["valorDocumento"], r["_deputado_id"], r["_batch_id"]) for r in rows] == [("1", "5.5", "9", "b"), ("2", "7", "9", "b"), ("3", "8", "9", "b")]
    assert [r["_rescued"] for r in rows] == [None, '{"novo":"{\\"x\\":1}"}', None] and rows[0]["_source_endpoint"] == "/deputados/despesas"
    for source in ("deputados", "votos", "frentes", "votacoes"):
        schema = P.bronze(landed, source).schema
        assert set(P.raw_schema(P.SOURCES[source][1]).fieldNames()) <= set(schema.fieldNames())
