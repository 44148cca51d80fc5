"""Where the layers live; any path Hadoop can resolve will do as the root."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Build:
    """Silver and gold of one build."""

    root: str

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


@dataclass(frozen=True)
class Layout:
    root: str

    @classmethod
    def local(cls, project: str) -> "Layout":
        return cls(f"{project.rstrip('/')}/data")

    @classmethod
    def bucket(cls, name: str, scheme: str = "s3a") -> "Layout":
        return cls(f"{scheme}://{name}")

    @classmethod
    def of(cls, environment: str, place: str) -> "Layout":
        """``local`` below a project folder, ``prod`` in a bucket."""
        known = {"local": cls.local, "prod": cls.bucket}
        if environment not in known:
            raise ValueError(f"environment is one of {', '.join(known)}, not {environment}")
        return known[environment](place)

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def builds(self) -> str:
        return f"{self.root}/builds"

    @property
    def published(self) -> str:
        return f"{self.root}/published"

    @property
    def kept(self) -> str:
        return f"{self.root}/kept"

    @property
    def checks(self) -> str:
        return f"{self.root}/checks"

    @property
    def failed_months(self) -> str:
        return f"{self.root}/artifacts/failed_bronze_months"

    @property
    def failed_landings(self) -> str:
        return f"{self.root}/artifacts/failed_raw_months"

    def build(self, version: str) -> Build:
        return Build(f"{self.builds}/{version}")
