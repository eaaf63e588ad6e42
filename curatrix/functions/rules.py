"""Domains, term tables, weights and thresholds. Operators take them as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# Closed domains. The order of labels breaks ties and orders reports.
PREFERENCE_LABELS = ("解码策略优化", "上下文与缓存优化", "系统与调度优化", "算子与内核优化", "模型压缩")
SCHEDULING_LABEL = "系统与调度优化"
RESEARCH_OBJECTS = (
    "LLM", "多模态 / VLM", "Diffusion / 生成模型", "通用机器学习", "强化学习 / 序列决策",
    "检索 / 推荐 / 搜索", "计算机视觉", "语音 / 音频", "AI 系统 / 基础设施", "评测 / Benchmark / 数据集",
)
DEFAULT_OBJECT = "通用机器学习"
# Words by which answers name objects; the first that an answer contains holds.
OBJECT_ALIASES = {
    "llm": "LLM", "vlm": "多模态 / VLM", "multimodal": "多模态 / VLM", "vision-language": "多模态 / VLM", "diffusion": "Diffusion / 生成模型", "reinforcement": "强化学习 / 序列决策",
    "retrieval": "检索 / 推荐 / 搜索", "recommend": "检索 / 推荐 / 搜索", "search": "检索 / 推荐 / 搜索", "vision": "计算机视觉", "image": "计算机视觉", "speech": "语音 / 音频",
    "audio": "语音 / 音频", "system": "AI 系统 / 基础设施", "infrastructure": "AI 系统 / 基础设施", "benchmark": "评测 / Benchmark / 数据集", "dataset": "评测 / Benchmark / 数据集",
}
TIERS = ("positive", "negative")
LEGACY_NEGATIVE_TIERS = ("easy", "in_domain", "hard")
REVIEW_STATUSES = ("pending", "conflict", "final")
EVIDENCE_EXTRA_KEYS = ("general", "negative")
SPLITS = ("dev", "dev_validation", "test")
OBJECT_BUCKETS = {"LLM": "LLM", "多模态 / VLM": "VLM", "Diffusion / 生成模型": "Diffusion"}
OTHER_BUCKET = "其他"
NEGATIVE_CLASS = "__negative__"

# Status words.
REJECT_STATUS = ("reject", "withdraw", "desk", "submitted", "under review")
ACCEPT_STATUS = ("accept", "accepted", "oral", "spotlight", "poster", "main", "technical")

# Label terms.
LABEL_TERMS = {
    "解码策略优化": ("decode", "decoding", "speculative", "early exit", "beam search", "autoregressive", "multi-token prediction", "draft model", "lookahead"),
    "上下文与缓存优化": ("kv cache", "cache eviction", "cache compression", "token pruning", "long context", "context compression", "prompt compression", "memory", "gist token"),
    "系统与调度优化": ("serving", "scheduling", "batching", "throughput", "latency", "runtime", "prefill", "deployment", "offloading", "cluster"),
    "算子与内核优化": ("kernel", "operator fusion", "compiler", "fused attention", "cuda", "attention kernel", "gpu", "flash attention", "gemm"),
    "模型压缩": ("quantization", "distillation", "pruning", "low-bit", "sparsity", "mixed-precision", "binary", "post-training quantization"),
}

# Research-object words, earlier rules win ties, repeated words count each time.
OBJECT_RULES = (
    ("LLM", "llm large language model language model autoregressive chat model reasoning model"),
    ("多模态 / VLM", "multimodal vlm vision-language text-image"),
    ("AI 系统 / 基础设施", "serving runtime compiler gpu cluster kernel systems infrastructure"),
    ("评测 / Benchmark / 数据集", "benchmark dataset evaluation leaderboard testbed"),
    ("Diffusion / 生成模型", "diffusion denoising flow-matching flow matching image synthesis"),
    ("强化学习 / 序列决策", "reinforcement learning decision-making policy optimization control bandit"),
    ("检索 / 推荐 / 搜索", "retrieval recommendation search ranking"),
    ("计算机视觉", "vision image video detection segmentation recognition"),
    ("语音 / 音频", "speech audio voice sound"),
    ("通用机器学习", "transformer neural network machine learning"),
)

# Venues, quotas, thresholds.
VENUE_QUOTAS = {("aaai", 2025): 40, ("iclr", 2025): 40, ("iclr", 2026): 40, ("icml", 2025): 40, ("nips", 2025): 40}
AUGMENT_VENUES = (("iclr", 2026), ("nips", 2025), ("icml", 2025), ("aaai", 2025))
MINIMUM_SCORE, SCHEDULING_MINIMUM_SCORE = 12, 8
SPLIT_SEED, SPLIT_BOUNDS = 42, (0.70, 0.85)
REFUSALS = ("请提供完整英文摘要内容", "无法进行忠实翻译", "你当前只给出了标题", "未提供摘要正文")
LONG_SOURCE, SHORT_TRANSLATION, SHORT_RATIO = 400, 120, 0.12
TRIM_CHARS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~，。！？；：、（）【】《》“”‘’"


@dataclass(frozen=True)
class TermScore:
    """Weights of contained terms: strong, context and exclude terms, and bonuses for any of some terms."""

    strong: tuple[str, ...]
    context: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    bonuses: tuple[tuple[tuple[str, ...], int], ...] = ()
    weights: tuple[int, int, int] = (3, 1, -3)


@dataclass(frozen=True)
class Group:
    """A group scores its weight and its hits, if it has hits and its gate is open: ``at_least`` of the gate's terms."""

    name: str
    terms: tuple[str, ...]
    weight: int
    gate: tuple[str, ...] = ()
    at_least: int = 0


@dataclass(frozen=True)
class GroupScore:
    phrases: tuple[str, ...] = ()
    phrase_weight: int = 6
    groups: tuple[Group, ...] = ()
    exclude: tuple[str, ...] = ()
    exclude_weight: int = -3
    #: all of the first terms and any of the second, points
    together: tuple[tuple[tuple[str, ...], tuple[str, ...], int], ...] = field(default=())


# Acceleration terms.
ACCELERATION = TermScore(
    strong=(
        "speculative decoding", "self-speculative", "draft model", "multi-token prediction", "kv cache", "cache compression", "cache eviction", "token pruning", "long context",
        "prefill", "continuous batching", "batching", "throughput", "latency", "serving", "runtime", "kernel", "fused attention", "flash attention", "cuda", "gemm",
        "quantization", "quantized", "4-bit", "3-bit", "2-bit", "low-bit", "distillation", "pruning", "sparsity", "compression", "compressed", "offloading", "mixed-precision",
    ),
    context=(
        "inference", "inferencing", "decode", "decoding", "serving", "generation", "autoregressive", "language model", "large language model", "llm",
        "transformer", "vision-language", "vlm", "multimodal", "reasoning model", "agent",
    ),
    exclude=(
        "training", "pretraining", "pre-training", "finetuning", "fine-tuning", "alignment", "preference optimization", "reward model",
        "reinforcement learning", "segmentation", "classification", "speech recognition",
    ),
    bonuses=((("llm", "language model", "autoregressive"), 2), (("inference", "serving", "decoding"), 2)),
)

# Scheduling terms.
SCHEDULING = GroupScore(
    phrases=(
        "muxserve", "distserve", "hexgen-2", "adaptive rescheduling in prefill-decode disaggregated llm inference",
        "efficiently serving large multimodal models using epd disaggregation", "epd-serve", "sem-moe", "capacity-aware inference", "spaceserve",
    ),
    groups=(
        Group("llm_serving", ("llm serving", "language model serving", "inference serving", "request scheduling", "continuous batching", "goodput", "tail latency", "admission control", "load balancing"), 4),
        Group("multi_tenant", ("multiple llm serving", "multiple model serving", "multi-tenant serving", "multi-tenant lora", "spatial-temporal multiplexing", "gpu multiplexing", "co-location", "shared gpu", "spatial multiplexing"), 4,
              ("lora", "llm", "serving", "language model"), 1),
        Group("pd_disaggregation", ("prefill-decode disaggregation", "prefill decoding disaggregation", "disaggregated llm serving", "disaggregated generative inference", "decode rescheduling", "kv cache transfer", "heterogeneous gpus", "heterogeneous gpu"), 5,
              ("prefill", "decode"), 2),
        Group("epd_disaggregation", ("encode-prefill-decode", "epd disaggregation", "multimodal serving", "large multimodal models", "stage-level disaggregation"), 5,
              ("multimodal", "encode", "prefill", "decode"), 1),
        Group("moe_scheduling", ("expert parallelism", "expert parallel inference", "moe serving", "all-to-all communication", "straggler effect", "expert routing", "sample placement", "model-data collaborative scheduling", "semantic parallelism"), 5,
              ("expert parallel", "all-to-all", "straggler", "routing"), 2),
    ),
    exclude=("training", "pretraining", "pre-training", "fine-tuning", "finetuning", "rlhf", "alignment", "reinforcement learning"),
    together=(
        (("slo",), ("serving", "latency", "throughput", "goodput"), 2),
        (("routing",), ("expert", "request", "token", "scheduler", "serving"), 2),
        ((), ("llm", "language model", "multimodal", "inference"), 2),
    ),
)
