"""Parameters of a pipeline run, with the defaults of the published pipeline."""

from __future__ import annotations

from dataclasses import Field, dataclass, field, fields

from .functions.names import parameter_text

STAGES = ("data_prep", "tile_filter", "segment", "cluster", "classify", "post_process", "cluster_tiles", "annotate")


@dataclass(frozen=True)
class PipelineConfig:
    start_from: str = "data_prep"
    filter_tiles: bool = True
    tile_size: int = 512
    magnifications: tuple[float, ...] = (1.0,)
    num_tiles: int | None = None
    slide_filter: tuple[str, ...] = ()
    min_edge_density: float = 0.02
    max_bright_ratio: float = 0.8
    max_dark_ratio: float = 0.8
    min_std_intensity: float = 10.0
    min_laplacian_var: float = 50.0
    min_color_variance: float = 5.0
    classify_per_cluster: int = 10
    class_labels: tuple[str, ...] = ()
    cluster_eps: float | None = None
    cluster_min_samples: int = 5
    cluster_metric: str = "euclidean"
    cluster_normalize: bool = False
    analyzer_threshold: float = 0.75
    analyzer_max_items: int | None = 20
    max_labels: int = 100
    color_by: str = "cluster"
    draw_polygon: bool = True
    draw_box: bool = False
    resume: bool = False
    segment_pretrained_model: str = "cpsam"
    segment_flow_threshold: float = 0.4
    segment_cellprob_threshold: float = 0.0
    segment_diameter: float | None = None
    segment_resample: bool = False
    segment_normalize: bool = True
    segment_use_gpu: bool = False
    segment_batch: int = 1
    cluster_use_gpu: bool = False
    cluster_use_umap: bool = False
    cluster_umap_components: int = 50
    cluster_per_slide: bool = False
    save_stats: bool = False
    enable_annotations: bool = False
    annotation_max_labels: int = 100
    annotation_random_labels: bool = False
    annotation_draw_bbox: bool = False
    annotation_draw_polygon: bool = False
    annotation_no_text: bool = False
    annotation_color_by: str = "cluster_id"
    annotation_filter_unclassified: bool = False
    enable_cluster_tiles: bool = False
    enable_filtered_annotations: bool = False
    filtered_annotation_max_labels: int = 100
    filtered_annotation_random_labels: bool = False
    filtered_annotation_draw_bbox: bool = False
    filtered_annotation_draw_polygon: bool = False
    filtered_annotation_no_text: bool = False
    filtered_annotation_color_by: str = "cluster_id"
    filtered_annotation_filter_unclassified: bool = False
    error_threshold: int = 5
    retries: int = 3
    timeout_seconds: int = 300
    files_per_batch: int = 1
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.start_from not in STAGES:
            raise ValueError(f"start_from must be one of {', '.join(STAGES)}")
        if not self.magnifications or min(self.magnifications) <= 0:
            raise ValueError("magnifications must be positive")
        if self.cluster_min_samples < 1 or self.tile_size < 1:
            raise ValueError("cluster_min_samples and tile_size must be at least 1")
        if self.color_by not in ("class", "cluster", "default", "none"):
            raise ValueError("color_by must be class, cluster, default or none")

    def limits(self) -> dict[str, float]:
        names = ("min_edge_density", "max_bright_ratio", "max_dark_ratio", "min_std_intensity", "min_laplacian_var", "min_color_variance")
        return {n: getattr(self, n) for n in names}

    def signature(self) -> str:
        """A run's name out of the parameters that shape its result: of the analyzer, of annotation, or of the whole pipeline."""
        if self.start_from == "cluster_tiles":
            return "_".join([*self._analyzer(), *self._drawing("filtered_annotation", "enable_filtered_annotations", "filteredAnnotated")]) or "default"
        if self.start_from == "annotate":
            return "_".join(self._drawing("annotation", "enable_annotations", "annotated")) or "default"
        t = parameter_text
        parts = [
            f"model_{t(self.segment_pretrained_model)}",
            f"prob_{t(self.segment_cellprob_threshold)}",
            f"flow_{t(self.segment_flow_threshold)}",
            f"eps_{t(self.cluster_eps)}",
            f"mins_{self.cluster_min_samples}",
        ]
        optional = (
            (self.segment_use_gpu, "segGPU"),
            (self.segment_diameter is not None, f"diam_{t(self.segment_diameter)}"),
            (self.segment_resample, "resample"),
            (not self.segment_normalize, "nonorm"),
            (self.cluster_normalize, "norm"),
            (self.cluster_use_gpu, "cluGPU"),
            (self.cluster_use_umap, f"umap_{self.cluster_umap_components}"),
            (self.cluster_per_slide, "perslide"),
            (True, f"mag_{t(','.join(map(str, self.magnifications)))}"),
            (self.num_tiles is not None, f"ntiles_{self.num_tiles}"),
            (self.filter_tiles, f"filtered_edge_{t(self.min_edge_density)}"),
            (self.enable_annotations, "annotated"),
        )
        parts += [text for wanted, text in optional if wanted] + self._analyzer()
        return "_".join(parts + ["filteredAnnotated"] * self.enable_filtered_annotations)

    def _analyzer(self) -> list[str]:
        if not self.enable_cluster_tiles:
            return []
        return [f"reptiles_{parameter_text(self.analyzer_threshold)}"] + [f"maxper_{self.analyzer_max_items}"] * (self.analyzer_max_items is not None)

    def _drawing(self, prefix: str, switch: str, name: str) -> list[str]:
        if not getattr(self, switch):
            return []
        get = lambda k: getattr(self, f"{prefix}_{k}")
        flags = (("random_labels", "random"), ("draw_bbox", "bbox"), ("draw_polygon", "poly"), ("no_text", "notext"))
        words = [w for k, w in flags if get(k)]
        return [name, f"maxlabels_{get('max_labels')}", *words, f"colorby_{get('color_by')}"] + ["filterunclass"] * get("filter_unclassified")

    def annotations_name(self, parametrised: bool = False) -> str:
        """The file name of a slide's annotations."""
        return f"v1_{self.signature()}_annotations.json" if parametrised else "final_annotations.json"

    @classmethod
    def from_environment(cls, values: dict[str, str], prefix: str = "TESSELLA_") -> PipelineConfig:
        """A configuration out of text values such as environment variables or Spark settings; unknown names are left out.

        Lists are separated by commas, ``none`` and empty text mean no value, ``true`` and ``false`` are booleans.
        """
        kinds = {f.name: f for f in fields(cls) if f.name != "extra"}
        given = {}
        for key, text in values.items():
            name = key[len(prefix) :].lower() if key.startswith(prefix) else None
            if name in kinds:
                given[name] = _value(text, kinds[name])
        return cls(**given)


def _value(text: str, f: Field) -> object:
    default, text = f.default, text.strip()
    if text.lower() in ("", "none"):
        return None
    if isinstance(default, bool):
        return text.lower() in ("1", "true", "yes")
    if isinstance(default, tuple):
        items = [v.strip() for v in text.split(",") if v.strip()]
        return tuple(float(v) for v in items) if "float" in str(f.type) else tuple(items)
    if isinstance(default, str):
        return text
    return float(text) if "float" in str(f.type) else int(text)
