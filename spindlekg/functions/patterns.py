"""The extraction rules as data: properties with their aliases and units, and treatments. Rules are arguments
everywhere; these are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PropertyRule:
    """`alias, up to ten characters that are no digit, number, unit`, whatever the case. Aliases and unit are patterns
    without anchors and without looking ahead or behind, so that a phrase found in a text is found in itself alike."""

    name: str
    aliases: tuple[str, ...]
    unit: str
    unit_pattern: str | None = None

    @property
    def pattern(self) -> str:
        # Fixed value: what may stand between alias and number, and what a number is, decide which texts match.
        return rf"(?iU)({'|'.join(self.aliases)})[^\d]{{0,10}}([0-9]+\.?[0-9]*)\s*{self.unit_pattern or self.unit}"


@dataclass(frozen=True)
class TreatmentRule:
    """A pattern, and texts of which each match holds one (none: not known)."""

    pattern: str
    literals: tuple[str, ...] = ()


# Aliases, units and treatment words that results must agree on.
PROPERTIES = (
    PropertyRule("屈服强度", ("屈服强度", "yield strength", "YS"), "MPa"),
    PropertyRule("抗拉强度", ("抗拉强度", "tensile strength", "UTS"), "MPa"),
    PropertyRule("硬度", ("硬度", "hardness", "HV"), "HV"),
    PropertyRule("伸长率", ("伸长率", "elongation", "延伸率"), "%"),
)
TOUGHNESS = PropertyRule("断裂韧性", ("断裂韧性", "fracture toughness", "KIC"), "MPa·m^0.5", r"MPa·m\^?0\.?5")
RELATION_PROPERTIES = (*PROPERTIES, TOUGHNESS)
HEAT_STAGE = TreatmentRule(r"(?iU)(T\d+|双级|单级)\s*(热处理|时效)", ("热处理", "时效"))
HEAT_STAGE_STRICT = TreatmentRule(r"(?iU)(T6|T4|双级|单级)\s*(热处理|时效)", ("热处理", "时效"))
HEAT_STEP = TreatmentRule(r"(?iU)(固溶|时效|退火|淬火|回火)\s*处理", ("处理",))
HEAT_CONDITION = TreatmentRule(r"(?iU)(\d+℃)[^\d]{0,5}(\d+[小时h])", ("℃",))
TREATMENTS = (HEAT_STAGE, HEAT_STEP, HEAT_CONDITION)
RELATION_TREATMENTS = (HEAT_STAGE_STRICT, HEAT_STEP, HEAT_CONDITION)

# Types, their aliases and ranks, section headings and display colours, which results show.
ENTITY_TYPES = ("MaterialAlloy", "AlloyComponent", "HeatTreatmentProcess", "ResearchSubject", "ResearchMethod", "MechanicalProperty", "MicrostructureFeature", "Application", "SourceDocument")
RELATION_TYPES = ("HAS_COMPONENT", "EXHIBITS_PROPERTY", "UNDERGOES_TREATMENT", "INVESTIGATED_BY", "HAS_MICROSTRUCTURE", "HAS_APPLICATION", "MENTIONED_IN")
ENTITY_TYPE_ALIASES = {"Alloy": "MaterialAlloy", "合金": "MaterialAlloy", "工艺": "HeatTreatmentProcess", "性能": "MechanicalProperty", "方法": "ResearchMethod", "试验": "ResearchMethod", "结构": "MicrostructureFeature"}
RELATION_TYPE_ALIASES = {"HAS_PROPERTY": "EXHIBITS_PROPERTY", "TREATED_BY": "UNDERGOES_TREATMENT", "INVESTIGATED": "INVESTIGATED_BY"}
RELATION_PRIORITY = {"HAS_COMPONENT": 1, "EXHIBITS_PROPERTY": 2, "UNDERGOES_TREATMENT": 3, "HAS_MICROSTRUCTURE": 4, "HAS_APPLICATION": 5, "INVESTIGATED_BY": 6}
SECTION_HEADINGS = ("ABSTRACT", "摘要", "INTRODUCTION", "介绍", "METHODS?", "方法", "RESULTS?", "结果", "DISCUSSION", "讨论", "CONCLUSION", "结论", "REFERENCES?", "参考文献")
LABEL_COLOURS = {"MaterialAlloy": "#add8e6", "HeatTreatmentProcess": "#90ee90", "MechanicalProperty": "#ffb6c1", "AlloyComponent": "#ffff99", "ResearchMethod": "#dda0dd", "Application": "#ff7f50", "SourceDocument": "#cccccc"}
DEFAULT_COLOUR = "#ffcc99"
# Process keywords and their order; the first in the list that a name holds decides.
PROCESS_KEYWORDS = (
    ("固溶", 1), ("solution", 1), ("SHT", 1), ("溶解", 1), ("dissolution", 1),
    ("淬火", 2), ("quench", 2), ("Q", 2), ("冷却", 2), ("water quench", 2),
    ("时效", 3), ("aging", 3), ("A", 3), ("ageing", 3), ("age", 3),
    ("人工", 3), ("artificial", 3), ("T6", 3), ("T5", 3), ("T4", 3),
    ("自然", 3), ("natural", 3), ("NA", 3), ("室温", 3), ("RT", 3),
    ("双级", 4), ("two-stage", 4), ("double", 4), ("二级", 4), ("T78", 4),
    ("峰值", 5), ("peak", 5), ("peak aging", 5), ("peak-aged", 5),
    ("过时效", 6), ("overaged", 6), ("over-aging", 6),
    ("预时效", 0), ("pre-aging", 0), ("preaged", 0),
    ("回火", 7), ("tempering", 7), ("退火", 8), ("annealing", 8),
    ("均匀化", 0), ("homogenization", 0), ("冷处理", 9), ("cold treatment", 9),
    ("热处理", 2), ("heat treatment", 2),
)
# Keys under which a stage's answer may come.
STAGE_KEYS = ("composition", "compositions", "alloy_composition", "alloy_compositions", "process", "processes", "heat_treatment_process", "heat_treatment_processes", "relationships", "causal_chain", "properties", "performance")
