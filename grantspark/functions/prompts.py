"""Fixed wording of the requests sent out as rows.

Fixed values throughout this file: answers depend on the wording, so it is kept as it is.
"""

from __future__ import annotations

PHASES_EXAMPLE = (
    '{"fases":[{"nome":"Inscrição","prazo":"...","status":"aberto|fechado|pendente","data_inicio":"YYYY-MM-DD","data_fim":"YYYY-MM-DD"}]}'
)
VALUE_EXAMPLE = (
    '{"valor_projeto":{"por_projeto":["até R$ 500.000,00 por proposta"],"por_projeto_min":null,"por_projeto_max":500000,"total_programa":"R$ 10.000.000,00 (valor global da chamada)",'
    '"qtd_projetos":20,"bolsas":["bolsa DTI-A R$ 3.000,00/mês"]}} ou {"valor_projeto":null}'
)
VALUE_RULES = (
    "- Separe o valor POR PROJETO do valor TOTAL do edital. São coisas diferentes:",
    '  • por_projeto: quanto CADA proposta/projeto/empresa pode pedir (teto, "até R$ X por proposta", "valor máximo por projeto", faixas/linhas/modalidades com seus tetos). Lista curta (máx. 6 itens, até ~120 caracteres cada), com o R$ como está no texto.',
    "  • por_projeto_min / por_projeto_max: números em reais (sem R$, sem pontos) do menor e do maior valor por projeto; null se não houver.",
    '  • total_programa: o orçamento global da chamada ("valor global", "recursos totais", "dotação orçamentária", "serão destinados R$ X para esta chamada", "montante total"). Texto curto com o R$. NUNCA coloque esse valor em por_projeto.',
    "  • qtd_projetos: número de projetos/propostas que serão apoiados, se o texto disser (inteiro); senão null.",
    '  • bolsas: valor de CADA bolsa (ex.: "bolsa DTI-A R$ 3.000,00/mês"), se houver. Limites de rubrica do orçamento do projeto não são bolsas.',
    "- Se o texto só informar o total da chamada, deixe por_projeto vazio ([]) e preencha total_programa. Não divida o total pelo número de projetos.",
    "- Use null/[] para o que não estiver no texto. Não invente valores.",
    '- NÃO use número de edital/chamada (ex. "046/2026", "00001946/2026") como valor',
    "- Não copie parágrafos inteiros do edital",
)


def example(field: str, audit: bool = False) -> str:
    """Answer format shown for a field."""
    if field == "valor_projeto" and not audit:
        return VALUE_EXAMPLE
    if field == "timeline_estimada":
        return f'{{"{field}":{PHASES_EXAMPLE}}} ou {{"{field}":null}}'
    if field in ("is_researcher", "is_company"):
        return f'{{"{field}": true}} ou {{"{field}": false}} ou {{"{field}": null}}'
    return f'{{"{field}":"texto..."}} ou {{"{field}": null}}'


AUDIT_HEAD = (
    "Você audita um valor já extraído de um edital.",
    "Tarefas:",
    "(1) Percorra o DOCUMENTO e verifique se existe, em outra parte do texto, informação mais específica, completa ou claramente melhor para o MESMO campo (não confunda com outros campos).",
    "(2) Verifique se o valor está correto e sustentado pelo texto; se estiver vago, contraditório ou sem suporte, corrija ou anule.",
    "Decisão em _audit.decision:",
    '- "accept": o valor está adequado (pode devolver equivalente).',
    '- "replace": há informação melhor no documento — preencha o campo com o melhor valor suportado.',
    '- "reject": não há suporte no documento — use null no campo.',
    "Não invente dados que não apareçam no documento.",
    "As linhas Edital/Fonte/Campo abaixo são só contexto: nunca as repita dentro do valor do campo.",
    "",
)
NO_EVIDENCE = "Não há trecho de evidência registrado (extração antiga). Use somente o documento abaixo."
GUIDANCE = {
    "valor_projeto": (
        "Valide e padronize o valor POR PROJETO/proposta (teto ou faixa que cada proposta pode pedir) ou por bolsa. O orçamento total/global da chamada NÃO é valor por projeto: se o valor atual for só o total,"
        ' mantenha-o identificado como "total da chamada" (ex.: "R$ 10.000.000,00 (valor global da chamada)") e nunca o apresente como teto por projeto.'
    ),
    "prazo_inscricao": "Valide e padronize o(s) prazo(s) de inscrição/submissão. Se houver datas e horários, preserve. Se houver múltiplas janelas/etapas, resuma em uma string única clara.",
    "localizacao": "Valide e padronize a elegibilidade geográfica/alcance (ex: 'Brasil', 'Estado do Ceará', 'Região Nordeste', 'Municípios do ES').",
    "vagas": "Valide e padronize número de vagas/projetos/bolsas/selecionados. Se houver faixas, descreva (ex: 'até 30 projetos').",
    "is_researcher": "Valide se o público-alvo inclui pesquisadores/ICTs/universidades como proponentes elegíveis. true/false/null (null se não houver evidência explícita).",
    "is_company": "Valide se o público-alvo inclui empresas/startups como proponentes elegíveis. true/false/null (null se não houver evidência explícita).",
    "sobre_programa": "Valide um parágrafo curto e objetivo sobre o programa/objetivo do edital, fiel ao texto (a redação final será refinada numa etapa separada).",
    "criterios_elegibilidade": "Valide e padronize critérios/requisitos de elegibilidade em texto corrido (ou linhas separadas por \\n) com linguagem fiel ao edital. Não invente.",
    "timeline_estimada": "Valide se existe cronograma/timeline no edital. Se sim, normalize para o formato do site (fases com datas/prazos quando existirem). Se não houver, retorne null.",
}
STIPEND_PROMPT = """Você extrai dados de editais de fomento brasileiros.
Pergunta: este edital define o valor mensal pago a cada bolsa? Se sim, qual é?

Regras:
- Use somente os trechos abaixo. Não use conhecimento externo.
- Se o edital só remeter a uma tabela ou portaria sem escrever o valor, responda null.
- Se houver mais de uma modalidade de bolsa com valor, junte num texto curto, ex.: "ATP-B: R$ 560,00/mês; ATP-A: R$ 700,00/mês".
- "evidencia" deve ser um trecho copiado literalmente de um dos trechos (até 220 caracteres) que contenha o valor.

Responda somente JSON: {"valor_bolsa": string|null, "evidencia": string|null}

TRECHOS:"""
