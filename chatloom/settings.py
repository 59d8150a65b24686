"""Job parameters that differ per deployment; defaults are examples only."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PublicName:
    """A person who agreed to be named: one display form, many spellings."""

    display: str
    spelling: str  # java.util.regex


@dataclass(frozen=True)
class NamePolicy:
    """Who may be named, and the consent mode in force."""

    mode: str = "anon"
    public_names: tuple[PublicName, ...] = (
        PublicName("가온쌤", r"가온\s?[샘쌤](?:\s*\(운영\))?"),
        PublicName("다솜쌤", r"다솜\s?[샘쌤](?:\s*\(총무\))?"),
        PublicName("라온쌤", r"라온\s?(?:지기)?\s?[샘쌤]"),
    )

    @property
    def displays(self) -> tuple[str, ...]:
        return tuple(p.display for p in self.public_names)


@dataclass(frozen=True)
class CrawlSource:
    """Scope of one crawled site."""

    source: str
    allowed_domains: tuple[str, ...]
    exclude_patterns: tuple[str, ...] = ()
    max_depth: int = 3
    languages: tuple[str, ...] = ("ko", "en")


#: Sections of a digest in order: id, short label, heading, and what stands in an empty one.
SECTIONS = (
    ("topics", "Topics", "많이 나눈 이야기", "주제로 묶인 대화가 없습니다."),
    ("solved", "Answers", "답을 찾은 질문", "답을 찾은 질문이 없습니다."),
    ("open", "Questions", "답을 찾는 질문", "남은 질문이 없습니다."),
    ("tips", "Know-how", "나눈 요령", "새로 나눈 요령이 없습니다."),
    ("actions", "To do", "할 일", "정한 일이 없습니다."),
    ("involved", "Join", "참여 방법", ""),
)
#: Terms of drafts and what readers get to see, longer ones first.
TERMS = (("현재 기간", "금주"), ("직전 기간", "전주"), ("기간", "주"), ("인원", "참여한 사람"))


@dataclass(frozen=True)
class DigestSettings:
    title_pattern: str = "주간 인사이트 {issue}호"
    embed_id: str = "insight-publication"
    chunk_sources: tuple[str, ...] = ("chat", "help", "site")
    policy: NamePolicy = field(default_factory=NamePolicy)
    sections: tuple[tuple[str, str, str, str], ...] = SECTIONS
    terms: tuple[tuple[str, str], ...] = TERMS
    #: What recovered pages get that have no introduction, or topics without a reason.
    no_intro: str = "소개 글이 없는 호입니다."
    no_reason: str = "이유가 적혀 있지 않습니다."


DEFAULTS = DigestSettings()
